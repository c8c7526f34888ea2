"""WARC: exact round trip of payloads, transactions wherever records lie."""

from __future__ import annotations

import gzip
import hashlib
import os
import uuid

import duckdb
from pyspark.sql import functions as F

from quarry.llm.warc import OP8_SQL, assemble, op8_warc, parse_records, read_warc, with_repeated, write_warc

SF = "/root/testdata/sf0.01"
LONG = "é" * 60
PAGES = [(1, "http://a/\r\nX: y", LONG), (2, None, LONG), (3, "u", None), (4, "u", "b\r\n\r\nWARC/1.1\r\n\r\n" + LONG), (5, "u", "b"), (6, "u", "b"), (0, "u", LONG), (-7, "u", "x" * 300_000)]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = sorted(con.execute(OP8_SQL).fetchall())
    names = [d[0] for d in con.description]
    assert sorted(tuple(r[n] for n in names) for r in op8_warc(spark, SF).collect()) == want


def test_round_trip_and_revisits(spark, scratch_dir):
    path = os.path.join(scratch_dir, "w")
    pages = spark.createDataFrame([(*p, "z", 1) for p in PAGES], "page_id bigint, url string, html string, digest string, id int").repartition(3)
    write_warc(pages, path)
    records = read_warc(spark, path)
    assert records.count() == 3 * len(PAGES)
    got = {int(r.metadata.fields["capture-id"]): r for r in assemble(records.repartition(5)).collect()}
    for ident, url, html in PAGES:
        r = got[ident]
        assert r.request.record_type == "request" and "\r" not in (r.target_uri or "") and "\n" not in (r.target_uri or "")
        if html == LONG and ident != 0:
            assert r.answer.record_type == "revisit" and r.answer.refers_to == "<urn:capture:response:0>" and r.answer.block == b""
        else:
            assert r.answer.record_type == "response" and r.answer.block.decode() == (html or "")
            assert r.answer.block_sha256 == hashlib.sha256((html or "").encode()).hexdigest()


def test_parser_reads_plain_and_per_record_gzip(spark, scratch_dir):
    record = lambda i, body: f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <r{i}>\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    bodies = [b"one\r\n\r\ntwo", b"", b"\x00\xff" * 70_000]
    plain = b"".join(record(i, b) for i, b in enumerate(bodies))
    members = b"".join(gzip.compress(record(i, b)) for i, b in enumerate(bodies))
    for raw in (plain, members, gzip.compress(plain)):
        assert [b for _, b in parse_records(raw)] == bodies
    with open(os.path.join(scratch_dir, "x.warc.gz"), "wb") as out:
        out.write(members)
    assert sorted(r.block_bytes for r in read_warc(spark, scratch_dir).collect()) == sorted(map(len, bodies))


def test_missing_partners_and_empty_tables(spark, scratch_dir):
    path = os.path.join(scratch_dir, uuid.uuid4().hex)
    write_warc(spark.createDataFrame(PAGES, "page_id bigint, url string, html string"), path)
    records = read_warc(spark, path, blocks=False)
    alone = assemble(records.where(F.col("record_type").isin("response", "revisit"))).collect()
    assert len(alone) == len(PAGES) and all(r.request is None and r.metadata is None for r in alone)
    assert assemble(records.where("record_type = 'request'")).count() == 0
    empty = os.path.join(scratch_dir, uuid.uuid4().hex)
    write_warc(spark.createDataFrame([], "page_id bigint, url string, html string"), empty)
    assert read_warc(spark, empty).count() == 0


def test_null_and_shared_ids(spark, scratch_dir):
    pages = [(None, "u", LONG), (None, "u", "other " * 30), (5, "u", LONG), (9, "u", LONG), (6, "u", "y" * 200), (6, "u", "y" * 200)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(os.path.join(scratch_dir, "pages.parquet"))
    got = sorted((tuple(r) for r in op8_warc(spark, scratch_dir).collect()), key=repr)
    digest = lambda t: (len(t.encode()), hashlib.sha256(t.encode()).hexdigest())
    want = [(i, *digest(t), "response", None, True) for i, _, t in pages if i != 9] + [(9, *digest(LONG), "revisit", 5, True)]
    assert got == sorted(want, key=repr)


def test_a_revisit_takes_what_its_response_holds(spark, scratch_dir):
    path = os.path.join(scratch_dir, uuid.uuid4().hex)
    write_warc(spark.createDataFrame(PAGES, "page_id bigint, url string, html string"), path)
    captures = assemble(read_warc(spark, path))
    whole = {r.record_id: r.repeated for r in with_repeated(captures).collect()}
    assert whole["<urn:capture:response:1>"].block_sha256 == hashlib.sha256(LONG.encode()).hexdigest() and whole["<urn:capture:response:3>"] is None
    lost = with_repeated(captures.where("record_id <> '<urn:capture:response:0>'")).where("answer.record_type = 'revisit'").collect()
    assert len(lost) == 2 and all(r.repeated is None for r in lost)
