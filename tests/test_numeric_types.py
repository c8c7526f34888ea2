"""Sums and percentages keep the value of every numeric type."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from quarry.functions.numeric import safe_pct
from quarry.operators.analytics import death_rate, ratio_having, sum_by


def test_decimals_and_doubles_are_not_truncated(spark):
    rows = [("a", Decimal("1.25"), 0.5, 3), ("a", Decimal("2.50"), 0.25, 4), (None, None, None, None)]
    df = spark.createDataFrame(rows, "k string, d decimal(10,2), f double, i int")
    got = {r.k: r for r in sum_by(df, ["k"], {"d": "d", "f": "f", "i": "i"}).collect()}
    assert (got["a"].d, got["a"].f, got["a"].i) == (Decimal("3.75"), 0.75, 7)
    assert got[None].i is None
    rate = death_rate(df.where("k = 'a'"), "d", "i").collect()
    assert sorted(r.death_rate_pct for r in rate) == [41.67, 62.5]


def test_percentages_of_very_large_counts(spark):
    big = 10**17
    df = spark.createDataFrame([("x", big, 3 * big), ("y", 9 * 10**18, 9 * 10**18)], "k string, deaths bigint, cases bigint")
    got = {r.k: r.p for r in df.select("k", safe_pct("deaths", "cases").alias("p")).collect()}
    assert got == {"x": 33.33, "y": 100.0}
    kept = ratio_having(df.where("k = 'x'"), ["k"], "deaths", "cases", min_pct=1.0).collect()
    assert [r.death_rate_pct for r in kept] == [33.33]


def test_rounding_stays_exact_next_to_a_tie(spark):
    df = spark.range(1).select(F.lit(4999999).cast("bigint").alias("n"), F.lit(10**11).cast("bigint").alias("d"))
    assert df.select(safe_pct("n", "d").alias("p")).first().p == 0.0
