"""Run metrics (A4-A8) in one aggregate, including edge inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators.profile import profile


def test_profile_metrics(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", float("nan")), ("b", None), (None, -2.0)], "k string, v double"
    )
    row = profile(df, distinct=["k"], min_max=["v"], conditions={"neg": F.col("v") < 0}, null_rates=["v"]).first()
    assert row.row_count == 4 and row.distinct_k == 2 and row.neg == 1
    assert row.null_rate_v == 0.5
    assert row.min_v == -2.0


def test_profile_empty_frame(spark):
    df = spark.createDataFrame([], "k string, v double")
    row = profile(df, distinct=["k"], null_rates=["v"]).first()
    assert row.row_count == 0 and row.distinct_k == 0 and row.null_rate_v is None
