"""Co-located joins: tables bucketed on the join key join without a shuffle."""

from __future__ import annotations

import uuid

from quarry.plans.layout import write_bucketed
from quarry.sources import tables as T
from tests.conftest import SF_SMALL


def test_bucketed_join_has_no_exchange(spark):
    db = f"layout_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    li = T.read_table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_quantity")
    od = T.read_table(spark, SF_SMALL, "orders").select("o_orderkey", "o_orderdate")
    lb = write_bucketed(li, f"{db}.lineitem_b", ["l_orderkey"], 8)
    ob = write_bucketed(od, f"{db}.orders_b", ["o_orderkey"], 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lb.join(ob, lb.l_orderkey == ob.o_orderkey)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        n = joined.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan
    assert "Exchange" not in plan
    assert n == li.join(od, li.l_orderkey == od.o_orderkey).count()
