"""CSV reading rules: doubled quotes, header check per file, short lines."""

from __future__ import annotations

import os

import pytest

from quarry.sources.csv import read_csv_projected
from quarry.streaming.ingest import read_csv_stream

HEADER = "iso_code,location,date,new_cases,new_deaths"


def _write(folder, name, *lines):
    with open(os.path.join(folder, name), "w") as out:
        out.write("\n".join(lines) + "\n")


def test_doubled_quotes_inside_a_field(spark, scratch_dir):
    _write(scratch_dir, "a.csv", HEADER, 'ABC,"Say ""hi"", ok",2024-01-01,1,0', 'DEF,"",2024-01-02,2,')
    rows = read_csv_projected(spark, scratch_dir).orderBy("iso_code").collect()
    assert rows[0].location == 'Say "hi", ok'
    assert rows[1].location is None and rows[1].new_deaths is None


def test_swapped_columns_in_another_file_raise(spark, scratch_dir):
    _write(scratch_dir, "a.csv", HEADER, "ABC,Abc,2024-01-01,1,0")
    _write(scratch_dir, "b.csv", "iso_code,location,date,new_deaths,new_cases", "DEF,Def,2024-01-01,7,9")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_projected(spark, scratch_dir).collect()


def test_swapped_columns_stop_the_stream(spark, scratch_dir):
    src = os.path.join(scratch_dir, "in")
    os.mkdir(src)
    _write(src, "b.csv", "iso_code,location,date,new_deaths,new_cases", "DEF,Def,2024-01-01,7,9")
    stream = read_csv_stream(spark, src, HEADER.split(","))
    query = stream.writeStream.format("noop").option("checkpointLocation", os.path.join(scratch_dir, "ck")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="Encountered error while reading file .*b.csv"):
        query.awaitTermination()


def test_short_lines_raise(spark, scratch_dir):
    _write(scratch_dir, "a.csv", HEADER, "ABC,Abc,2024-01-01")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_projected(spark, scratch_dir).collect()
