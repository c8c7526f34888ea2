"""Validation suite (V1-V11), gate (G1) and constraint checks (V12) on the
validator's own self-test frames and on edge cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.operators import quality as Q
from quarry.sources.inline import daily_dates


@pytest.fixture(scope="module")
def good(spark):
    # the validator's first self-test frame: 150 days from 2024-10-01, five
    # countries cycling with their case/death counts
    codes = ["IND", "USA", "DEU", "ARE", "BRA"]
    names = ["India", "United States", "Germany", "UAE", "Brazil"]
    cases = [100, 200, 50, 30, 80]
    deaths = [2, 5, 1, 0, 3]
    rows = [(i, codes[i % 5], names[i % 5], cases[i % 5], deaths[i % 5]) for i in range(150)]
    attrs = spark.createDataFrame(rows, "i long, iso_code string, country string, cases long, deaths long")
    days = daily_dates(spark, dt.date(2024, 10, 1), 150).select(
        "event_date",
        F.datediff(F.to_date("event_date"), F.lit(dt.date(2024, 10, 1))).cast("long").alias("i"),
    )
    return attrs.join(days, "i").drop("i")


@pytest.fixture(scope="module")
def bad(spark):
    rows = [
        ("IND", "India", dt.datetime(2024, 1, 15), 100, 2),
        (None, None, dt.datetime(2024, 1, 16), -50, 1),
        ("invalid", "Unknown", dt.datetime(2025, 12, 31), 200, 5),
        ("USA", "USA", dt.datetime(2024, 1, 17), 0, 0),
        ("DEU", "Germany", dt.datetime(2024, 1, 18), 50, 1),
    ]
    return spark.createDataFrame(rows, "iso_code string, country string, event_date timestamp_ntz, cases long, deaths long")


def _by_name(rows):
    return {r["check_name"]: r for r in rows}


def test_good_frame_ten_pass_coverage_fails(good):
    passed, rows = Q.validate(good, dt.datetime(2025, 6, 1))
    assert len(rows) == 11 and not passed
    failed = [r["check_name"] for r in rows if not r["passed"]]
    assert failed == ["country_coverage"]
    r = _by_name(rows)
    assert r["not_empty"]["message"] == "DataFrame has 150 rows (minimum: 100)"
    assert r["country_coverage"]["message"] == "5 countries found (minimum: 50)"
    assert r["date_range"]["message"] == "Dates OK. Range: 2024-10-01 to 2025-02-27"
    assert r["null_rate_cases"]["message"] == "Null rate: 0.0% (max allowed: 10.0%)"
    assert r["unique_combinations"]["message"] == "Uniqueness OK: 0 duplicates (0.0%)"


@pytest.mark.parametrize(
    "now,date_range_passes",
    [(dt.datetime(2025, 6, 1), False), (dt.datetime(2026, 12, 1), True)],
)
def test_bad_frame(bad, now, date_range_passes):
    passed, rows = Q.validate(bad, now)
    assert not passed
    got = [(r["check_name"], r["passed"]) for r in rows]
    assert got == [
        ("not_empty", False),
        ("required_columns", True),
        ("null_rate_iso_code", False),
        ("null_rate_event_date", True),
        ("null_rate_cases", True),
        ("no_negatives_cases", False),
        ("no_negatives_deaths", True),
        ("date_range", date_range_passes),
        ("iso_code_format", False),
        ("unique_combinations", True),
        ("country_coverage", False),
    ]
    r = _by_name(rows)
    assert r["iso_code_format"]["metric"] == 2.0
    assert r["null_rate_iso_code"]["metric"] == pytest.approx(0.2)
    assert r["no_negatives_cases"]["message"] == "1 negative values found"
    assert r["country_coverage"]["metric"] == 4.0


def test_missing_column_fails_instead_of_raising(spark, bad):
    df = bad.drop("cases")
    rows = Q.run_checks(df, [Q.null_rate(df, "cases"), Q.no_negatives(df, "cases"), Q.required_columns(df)]).collect()
    assert [(r.check_name, r.passed) for r in rows] == [
        ("null_rate_cases", False),
        ("no_negatives_cases", False),
        ("required_columns", False),
    ]
    assert rows[0].message == "Column 'cases' does not exist"
    assert rows[2].message == "Missing columns: ['cases']"


def test_empty_frame_rates(spark, bad):
    empty = bad.limit(0)
    rows = _by_name(Q.run_checks(empty, [Q.null_rate(empty, "iso_code", 0.05), Q.unique_combinations(empty, ["iso_code"])]).collect())
    assert rows["null_rate_iso_code"]["metric"] == 1.0 and not rows["null_rate_iso_code"]["passed"]
    assert rows["unique_combinations"]["metric"] == 0.0 and rows["unique_combinations"]["passed"]


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "v double")
    row = Q.run_checks(df, [Q.null_rate(df, "v", 0.5)]).collect()[0]
    assert row.metric == 0.5 and row.passed


def test_duplicates_count_null_keys_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("A", 1), ("A", 2)], "a string, b int")
    row = Q.run_checks(df, [Q.unique_combinations(df, ["a", "b"], 0.0)]).collect()[0]
    assert row.metric == 0.25 and not row.passed


def test_code_format_is_strict(spark):
    df = spark.createDataFrame([("IND",), ("IND\n",), ("ind",), (None,), ("INDI",)], "iso_code string")
    row = Q.run_checks(df, [Q.code_format(df)]).collect()[0]
    assert row.metric == 4.0


def test_negative_sample_is_capped(spark, bad):
    rows = Q.negative_sample(bad, "cases", ["event_date"]).collect()
    assert [r.cases for r in rows] == [-50]


def test_gate_quirks(spark):
    now = dt.datetime(2025, 6, 1)
    rows = [("IND", "India", dt.datetime(2024, 1, 1), 1, -1), (None, "X", dt.datetime(2024, 1, 2), 1, 0)]
    df = spark.createDataFrame(rows, "iso_code string, country string, event_date timestamp_ntz, cases long, deaths long")
    passed, out = Q.gate(df, now)
    r = _by_name(out)
    assert not passed
    # negative deaths are not checked by the gate; a NULL code has a wrong length
    assert r["gate_no_negative_cases"]["passed"]
    assert not r["gate_iso_code_length"]["passed"] and r["gate_iso_code_length"]["metric"] == 1.0
    assert not r["gate_iso_code_null_rate"]["passed"]
    assert r["gate_future_dates"]["passed"]


def test_gate_empty_frame_only_rule_one_fails(spark):
    df = spark.createDataFrame([], "iso_code string, country string, event_date timestamp_ntz, cases long, deaths long")
    passed, out = Q.gate(df, dt.datetime(2025, 6, 1))
    assert not passed
    assert [r["check_name"] for r in out if not r["passed"]] == ["gate_not_empty"]


def test_gate_future_date(spark):
    df = spark.createDataFrame(
        [("IND", "India", dt.datetime(2025, 6, 2, 0, 0, 1), 1, 1)],
        "iso_code string, country string, event_date timestamp_ntz, cases long, deaths long",
    )
    _, out = Q.gate(df, dt.datetime(2025, 6, 1))
    assert not _by_name(out)["gate_future_dates"]["passed"]


def test_constraint_checks(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "id int, name string")
    fact = spark.createDataFrame([(1,), (3,), (None,)], "fk int")
    out = {r.check_name: r.violations for r in Q.constraint_checks(dim, not_null=["id"], unique=[["id"]]).collect()}
    assert out == {"not_null_id": 1, "unique_id": 1}
    fk = Q.constraint_checks(fact, foreign_keys=[("fk", dim, "id")]).collect()
    assert fk[0].violations == 1


def test_render_result_lines(spark, bad):
    rows = Q.render(Q.run_checks(bad, [Q.not_empty(bad, 100), Q.required_columns(bad)])).collect()
    assert [r.line for r in rows] == [
        "[FAIL ✗] not_empty: DataFrame has 5 rows (minimum: 100)",
        "[PASS ✓] required_columns: All required columns present",
    ]
