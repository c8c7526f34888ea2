"""Records with quoted line breaks, read by byte ranges, against Python's csv."""

from __future__ import annotations

import csv
import datetime as dt
import os
import random

import pandas as pd
import pytest

from quarry.plans import driver_loads as L
from quarry.plans.elt import run_elt
from quarry.plans.warehouse import Warehouse
from quarry.schemas import RAW_COLUMNS
from quarry.sources.csv import MissingColumnsError
from quarry.sources.csv_records import read_csv_records, read_records
from quarry.sources.inline import reference_tables

NAMES = ["a", "b", "c"]


def _put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as out:
        out.write(text)
    return path


@pytest.fixture()
def small_blocks(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    held = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "64")
    yield
    for n, v in held.items():
        spark.conf.set(n, v)


def test_random_records_equal_the_csv_module(spark, scratch_dir, small_blocks):
    rng = random.Random(5)
    pieces = ["x", ",", '"', "\n", "\r\n", "word ", "é", "\n\n", "long " * 30]
    want = []
    for f in range(3):
        rows = [[f"{f}-{i}", "".join(rng.choices(pieces, k=rng.randint(0, 5))), "".join(rng.choices(pieces, k=rng.randint(0, 4)))] for i in range(60)]
        with open(os.path.join(scratch_dir, f"{f}.csv"), "w", newline="") as out:
            csv.writer(out, lineterminator="\r\n" if f == 1 else "\n").writerows([NAMES, *rows])
        want += [(a, b or None, c or None) for a, b, c in rows]
    got = read_csv_records(spark, scratch_dir, NAMES, ("",))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert spark.read.text(scratch_dir).rdd.getNumPartitions() > 30


def test_field_over_many_blocks_and_block_ends(spark, scratch_dir, small_blocks):
    long = "\n".join(f"line {i}" for i in range(200))
    _put(scratch_dir, "a.csv", f'a,b,c\n1,"{long}",x\n2,y,"z\n"\n3,"{long}","{long}"\n\n4,,')
    got = {r.a: (r.b, r.c) for r in read_csv_records(spark, scratch_dir, NAMES, ("",)).collect()}
    assert got == {"1": (long, "x"), "2": ("y", "z\n"), "3": (long, long), "4": (None, None)}
    assert read_records(spark, scratch_dir).where("first").count() == 1


def test_short_long_and_missing(spark, scratch_dir):
    short = os.path.join(scratch_dir, "s")
    os.mkdir(short)
    _put(short, "a.csv", "a,b,c\n1,NA\n2\n\n3,x,y\n")
    got = sorted(tuple(r) for r in read_csv_records(spark, short, NAMES).select("a", "b", "c").collect())
    assert got == [("1", None, None), ("2", None, None), ("3", "x", "y")]
    with pytest.raises(MissingColumnsError):
        read_csv_records(spark, short, ["a", "other"])
    long = os.path.join(scratch_dir, "l")
    os.mkdir(long)
    path = _put(long, "a.csv", "a,b,c\n0,0,0\n1,2,3,\n4,5,6,7,8\n9\n")
    frame = pd.read_csv(path, usecols=["a", "c"], dtype=str)
    want = [(a, None if pd.isna(c) else c) for a, c in zip(frame["a"], frame["c"])]
    assert {tuple(r) for r in read_csv_records(spark, long, ["a", "c"]).collect()} == set(want) and len(want) == 4
    other = os.path.join(scratch_dir, "o")
    os.mkdir(other)
    _put(other, "a.csv", "a,b,c\n1,2,3\n")
    _put(other, "b.csv", "a,c,b\n1,2,3\n")
    with pytest.raises(Exception, match="another header"):
        read_csv_records(spark, other, NAMES).collect()


def test_run_over_a_file_with_breaks(spark, scratch_dir):
    """The whole run takes such a file by the record reader."""
    place = 'Land\nof "x", y'
    quoted = place.replace('"', '""')
    days = [f'{code},"{quoted}",2024-01-{day:02d},{day},0' for code in ("ABC", "DEF") for day in range(1, 29)]
    path = _put(scratch_dir, "a.csv", ",".join(RAW_COLUMNS) + "\n" + "\n".join(days) + "\nGHI,Short,2024-01-30,7\n")
    wh = Warehouse(spark, "q_" + os.path.basename(scratch_dir).replace("-", "_"))
    wh.create()
    wh.seed(reference_tables(spark))
    run_elt(spark, path, wh, run_ts=dt.datetime(2024, 3, 1), read=read_csv_records)
    assert wh.count("fact_health_events") == 57
    names = wh.table("staging_health_events").groupBy("country").count().collect()
    assert {r.country: r["count"] for r in names} == {place: 56, "Short": 1}


def test_texts_with_line_breaks_come_back_whole(spark, small_blocks):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    sf = "/root/testdata/sf0.001"
    want = {(r.doc_id, r.source, r.text or None) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = L.csv_texts_with_breaks(spark, sf).collect()
    assert {(r.doc_id, r.source, r.text) for r in got} == want and len(got) == len(want)
    assert any("\n" in (r.text or "") for r in got)
