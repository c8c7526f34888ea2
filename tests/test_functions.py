"""Column helpers: exact percentages, truncation, NA tokens, code pattern,
calendar attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quarry.functions import (
    day_name,
    decode_na,
    iso_week,
    matches_code,
    minutes_between,
    month_name,
    safe_pct,
    truncate_count,
)


def _one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_safe_pct_exact_and_null(spark):
    data = [(62, 4200), (380, 45000), (499, 10_000_000), (1, 0), (None, 5), (1, 200), (-1, 200)]
    got = _one(spark, safe_pct("d", "c"), data, "d long, c long")
    # 499 / 10,000,000 is 0.00499 %, rounds to 0.00 (not 0.01)
    assert got == [1.48, 0.84, 0.0, None, None, 0.5, -0.5]


def test_truncate_count(spark):
    data = [(None,), (float("nan"),), (-0.5,), (3.9,), (-50.0,), (7.0,)]
    assert _one(spark, truncate_count("x"), data, "x double") == [0, 0, 0, 3, -50, 7]


def test_decode_na_tokens(spark):
    data = [("",), ("NA",), ("NaN",), ("null",), ("NAM",), ("-",), ("#N/A",), ("IND",)]
    assert _one(spark, decode_na("x"), data, "x string") == [None, None, None, None, "NAM", "-", None, "IND"]


def test_matches_code(spark):
    data = [("IND",), ("ind",), ("IND\n",), (None,), ("OWID_WRL",), ("IN",)]
    assert _one(spark, matches_code("x"), data, "x string") == [True, False, False, False, False, False]


def test_calendar_attributes(spark):
    data = [(dt.date(2024, 12, 1),), (dt.date(2020, 12, 31),), (dt.date(2024, 1, 15),)]
    df = spark.createDataFrame(data, "d date")
    rows = df.select(iso_week("d"), month_name("d"), day_name("d"), month_name("d", pad=True), day_name("d", pad=True)).collect()
    assert [tuple(r) for r in rows] == [
        (48, "December", "Sunday", "December ", "Sunday   "),
        (53, "December", "Thursday", "December ", "Thursday "),
        (3, "January", "Monday", "January  ", "Monday   "),
    ]


def test_minutes_between_keeps_fractions(spark):
    a = dt.datetime(2024, 1, 15, 9, 30, 0, 1)
    b = dt.datetime(2024, 1, 15, 9, 0, 0)
    got = _one(spark, minutes_between(F.col("a"), F.col("b")), [(a, b)], "a timestamp_ntz, b timestamp_ntz")
    assert got[0] > 30.0 and abs(got[0] - (30 + 1e-6 / 60)) < 1e-12
