"""One test per remaining trap of the survey (section 7.4)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.operators.calendar import calendar_rows
from quarry.operators.facts import build_facts, orphan_keys, unmatched_staging
from quarry.operators.keys import assign_keys
from quarry.operators.ordered import rank_and_lag
from quarry.sources.inline import seed_tables

STAGING = "iso_code string, country string, event_date timestamp_ntz, cases long, deaths long, source_name string, loaded_at timestamp_ntz"


def _staging(spark, rows):
    ts = dt.datetime(2025, 6, 1)
    return spark.createDataFrame([(*r, "src", ts) for r in rows], STAGING)


def test_t1_null_measure_ranks_first_descending(spark):
    df = spark.createDataFrame([(1, None, 1), (1, 10, 2), (1, 5, 3)], "g int, v int, t int")
    got = {r.t: (r["rank"], r.prev_value) for r in rank_and_lag(df, ["g"], "v", ["t"]).collect()}
    assert got == {1: (1, None), 2: (2, None), 3: (3, 10)}


def test_t2_int_overflow_raises_on_fact_load(spark):
    staging = _staging(spark, [("IND", "India", dt.datetime(2024, 1, 15), 3_000_000_000, 1)])
    dims = seed_tables(spark)
    dd = spark.createDataFrame([(1, dt.date(2024, 1, 15))], "date_id long, full_date date")
    facts = build_facts(staging, dd, dims["dim_location"])
    with pytest.raises(Exception):
        facts.collect()


def test_t12_keys_are_stable_across_actions(spark):
    df = spark.range(0, 2000).select((F.col("id") * 37 % 2000).alias("k")).repartition(9)
    keyed = assign_keys(df, "kid", ["k"])
    first = sorted((r.k, r.kid) for r in keyed.collect())
    second = sorted((r.k, r.kid) for r in keyed.collect())
    assert first == second


def test_t13_unmatched_staging_rows_are_reported(spark):
    staging = _staging(
        spark,
        [
            ("IND", "India", dt.datetime(2024, 1, 15), 5, 1),
            ("JPN", "Japan", dt.datetime(2024, 1, 15), 5, 1),      # no location
            ("IND", "India", dt.datetime(2030, 1, 1), 5, 1),       # no date
        ],
    )
    dims = seed_tables(spark)
    lost = unmatched_staging(staging, dims["dim_date"], dims["dim_location"]).collect()
    assert sorted((r.iso_code, str(r.event_date.date())) for r in lost) == [("IND", "2030-01-01"), ("JPN", "2024-01-15")]
    facts = build_facts(staging, dims["dim_date"], dims["dim_location"]).collect()
    assert len(facts) == 1


def test_t15_constant_keys_must_exist(spark):
    dims = seed_tables(spark)
    staging = _staging(spark, [("IND", "India", dt.datetime(2024, 1, 15), 5, 1)])
    facts = build_facts(staging, dims["dim_date"], dims["dim_location"], disease_id=9)
    assert orphan_keys(facts, dims["dim_disease"], "disease_id").count() == 1
    ok = build_facts(staging, dims["dim_date"], dims["dim_location"], disease_id=1)
    assert orphan_keys(ok, dims["dim_disease"], "disease_id").count() == 0


def test_t10_padded_calendar_names(spark):
    staging = _staging(spark, [("IND", "India", dt.datetime(2024, 12, 1, 13, 0), 1, 1)])
    row = calendar_rows(staging, "event_date", pad_names=True).collect()[0]
    assert (row.month_name, row.day_of_week, row.week) == ("December ", "Sunday   ", 48)
