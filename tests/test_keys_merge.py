"""Surrogate keys and dimension loads (insert-new, upsert)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarry.operators.keys import assign_keys
from quarry.operators.merge import DuplicateKeyError, first_per_key, insert_new, new_rows, upsert

DIM = "location_id long, country string, region string, continent string, iso_code string"


def test_assign_keys_dense_and_ordered_across_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(13)
    out = assign_keys(df, "kid", ["k"], start_after=100, num_partitions=7)
    rows = sorted((r.k, r.kid) for r in out.collect())
    assert [kid for _, kid in rows] == list(range(101, 5101))
    # ids follow key order
    assert all(a[1] < b[1] for a, b in zip(rows, rows[1:]))


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame([("IND", "India"), ("IND", "Bharat"), ("USA", "USA")], "iso_code string, country string")
    got = sorted(tuple(r) for r in first_per_key(df, ["iso_code"]).collect())
    assert got == [("IND", "Bharat"), ("USA", "USA")]


def test_insert_new_skips_existing_and_nulls_and_is_idempotent(spark):
    existing = spark.createDataFrame([(1, "India", "South Asia", "Asia", "IND")], DIM)
    incoming = spark.createDataFrame(
        [("India2", None, None, "IND"), ("Japan", None, None, "JPN"), ("Nowhere", None, None, None), ("Japan", None, None, "JPN")],
        "country string, region string, continent string, iso_code string",
    )
    once = insert_new(existing, incoming, ["iso_code"], "location_id")
    got = sorted((r.location_id, r.country, r.iso_code) for r in once.collect())
    assert got == [(1, "India", "IND"), (2, "Japan", "JPN")]
    twice = insert_new(once, incoming, ["iso_code"], "location_id")
    assert sorted((r.location_id, r.country, r.iso_code) for r in twice.collect()) == got


def test_new_rows_on_empty_dimension(spark):
    empty = spark.createDataFrame([], DIM)
    incoming = spark.createDataFrame([("B", None, None, "BBB"), ("A", None, None, "AAA")], "country string, region string, continent string, iso_code string")
    rows = sorted((r.location_id, r.iso_code) for r in new_rows(empty, incoming, ["iso_code"], "location_id").collect())
    assert rows == [(1, "AAA"), (2, "BBB")]


def test_upsert_updates_listed_columns_even_to_null(spark):
    existing = spark.createDataFrame(
        [(1, "India", "South Asia", "Asia", "IND"), (2, "Germany", "Western Europe", "Europe", "DEU")], DIM
    )
    incoming = spark.createDataFrame(
        [("Bharat", None, "Asia-Pacific", "IND"), ("Japan", "East Asia", "Asia", "JPN"), ("Atlantis", "Sea", "Sea", None)],
        "country string, region string, continent string, iso_code string",
    )
    out = {(r.iso_code, r.location_id): (r.country, r.region, r.continent) for r in upsert(existing, incoming, ["iso_code"], ["region", "continent"], "location_id").collect()}
    # country and id keep their old values; NULL region overwrites
    assert out[("IND", 1)] == ("India", None, "Asia-Pacific")
    assert out[("DEU", 2)] == ("Germany", "Western Europe", "Europe")
    # new rows get ids after the maximum, in key order with NULL keys last;
    # a NULL key never conflicts: it is inserted
    assert out[("JPN", 3)] == ("Japan", "East Asia", "Asia")
    assert out[(None, 4)] == ("Atlantis", "Sea", "Sea")
    assert len(out) == 4


def test_upsert_rejects_duplicate_keys_in_batch(spark):
    existing = spark.createDataFrame([], DIM)
    incoming = spark.createDataFrame([("A", None, None, "AAA"), ("B", None, None, "AAA")], "country string, region string, continent string, iso_code string")
    with pytest.raises(DuplicateKeyError):
        upsert(existing, incoming, ["iso_code"], ["region"], "location_id")


def test_assign_keys_with_adaptive_range_partitions(spark):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        df = spark.range(0, 3000).select((F.col("id") * 7919 % 3000).alias("k")).repartition(11)
        out = assign_keys(df, "kid", ["k"])
        rows = sorted((r.k, r.kid) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert [kid for _, kid in rows] == list(range(1, 3001))


def test_null_keyed_rows_get_the_same_ids_on_every_run(spark):
    # ties on a NULL key are broken by the other columns, whatever the arrival order
    rows = [(None, i * 31 % 200) for i in range(200)] + [(i, 0) for i in range(50)]
    want = None
    for parts in (1, 7, 13):
        df = spark.createDataFrame(rows, "k int, v int").repartition(parts)
        got = sorted((r.kid, r.v) for r in assign_keys(df, "kid", ["k"], start_after=5, num_partitions=parts).collect())
        want = want or got
        assert got == want and [i for i, _ in got] == list(range(6, 256))
