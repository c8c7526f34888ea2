"""The star join leaves the physical join to the planner."""

from __future__ import annotations

from quarry.operators.joins import star_join


def test_star_join_follows_the_planners_threshold(spark):
    fact = spark.range(0, 1000).selectExpr("id AS k", "id % 7 AS k2")
    dims = [(spark.range(0, 50).withColumnRenamed("id", "k"), "k"), (spark.range(0, 7).withColumnRenamed("id", "k2"), ["k2"])]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold, broadcast in (("-1", False), ("10MB", True)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            starred = star_join(fact, dims)
            assert ("BroadcastHashJoin" in starred._jdf.queryExecution().executedPlan().toString()) == broadcast
            assert starred.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
