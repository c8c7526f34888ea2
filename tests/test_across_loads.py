"""Results kept across loads: sessions, exact distinct counts, check results;
and the selection beyond Spark's group limit."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import analytics as A
from quarry.operators import distinct as D
from quarry.operators import quality as Q
from quarry.operators import sessions as S
from quarry.operators.ordered import sessionize
from quarry.sources import tables as T
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 15, 9)


def _rows(df, cols=None):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=repr)


def _events(n=400, seed=3):
    rng = random.Random(seed)
    minutes = sorted(rng.choice([0, 1, 5, 30, 31, 95]) * i // 3 for i in range(n))
    return [(rng.choice([1, 2, 3, None]), T0 + dt.timedelta(minutes=m), k) for k, m in enumerate(minutes)]


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("cuts", [(200,), (1, 399), (100, 100, 250)])
def test_sessions_of_several_loads_equal_one_run(spark, cuts, hot):
    data = _events()
    schema = "u int, ts timestamp_ntz, k int"
    options = {"max_group_rows": 20} if hot else {}
    want = sessionize(spark.createDataFrame(data, schema), ["u"], "ts", 30, ["k"])
    state, got = None, []
    for lo, hi in zip((0, *cuts), (*cuts, len(data))):
        part = spark.createDataFrame(data[lo:hi], schema)
        done = S.sessionize_load(part, state, ["u"], "ts", 30, ["k"], **options)
        got += _rows(done, ["k", "u", "gap_minutes", "session_id"])
        state = spark.createDataFrame(S.session_state(done, state, ["u"], "ts").collect(), "u int, last_time timestamp_ntz, sessions bigint")
    assert sorted(got, key=repr) == _rows(want, ["k", "u", "gap_minutes", "session_id"])
    assert {r.u: r.sessions for r in state.collect()} == {r.u: r.s for r in want.groupBy("u").agg(F.max("session_id").alias("s")).collect()}


def test_late_and_timeless_events(spark):
    schema = "u int, ts timestamp_ntz, k int"
    first = S.sessionize_load(spark.createDataFrame([(1, T0, 1), (1, None, 2), (2, T0, 3)], schema), None, ["u"], "ts")
    assert _rows(first, ["k", "gap_minutes", "session_id"]) == [(1, None, 1), (2, None, None), (3, None, 1)]
    state = S.session_state(first, None, ["u"], "ts")
    early = spark.createDataFrame([(1, T0 - dt.timedelta(seconds=1), 4), (2, T0, 5), (9, T0, 6)], schema)
    assert [r.k for r in S.late_events(early, state, ["u"], "ts").collect()] == [4]
    with pytest.raises(S.LateEventsError):
        S.sessionize_load(early, state, ["u"], "ts")
    on_time = S.sessionize_load(early.where("k > 4"), state, ["u"], "ts")
    assert _rows(on_time, ["k", "gap_minutes", "session_id"]) == [(5, 0.0, 1), (6, None, 1)]
    nothing = S.sessionize_load(early.limit(0), state, ["u"], "ts")
    assert nothing.count() == 0 and S.session_state(nothing, state, ["u"], "ts").count() == 2


def test_merged_distinct_counts_are_exact(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.choice([None, -5, 0, 32767, 32768, 10**12, rng.randrange(10**6)])) for _ in range(3000)]
    df = spark.createDataFrame(data, "g string, h int, i bigint")
    states = [D.distinct_state(part, ["g", "h"], "i") for part in df.randomSplit([0.3, 0.7], seed=1)]
    state = D.merge_states(states, ["g", "h"])
    for keys in (["g", "h"], ["g"], ["h"]):
        assert _rows(D.distinct_counts(state, keys)) == _rows(df.groupBy(*keys).agg(F.count_distinct("i").alias("distinct_ids")))
    assert D.distinct_counts(state, []).first()[0] == len({i for _, _, i in data if i is not None})
    empty = D.distinct_state(df.limit(0), ["g"], "i")
    assert D.distinct_counts(empty, ["g"]).count() == 0 and D.distinct_counts(empty, []).first()[0] == 0


def test_merged_checks_equal_one_pass(spark):
    data = [("IND", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), i - 3, None if i % 4 else 1) for i in range(50)]
    df = spark.createDataFrame(data, "iso_code string, event_date timestamp_ntz, cases int, deaths int")
    now = dt.datetime(2024, 2, 1)

    def specs(x):
        return [Q.not_empty(x), Q.required_columns(x), Q.null_rate(x, "deaths"), Q.no_negatives(x, "cases"), Q.date_range(x, "event_date", now), Q.code_format(x), *Q.gate_specs(x, now)]

    batches = [df.where("cases < 0"), df.where("cases >= 0"), df.limit(0)]
    merged = Q.merge_check_states([Q.check_state(b, specs(b)) for b in batches])
    cols = ["check_name", "passed", "metric", "threshold", "message"]
    assert _rows(Q.results_of_state(merged, specs(df)), cols) == _rows(Q.run_checks(df, specs(df)), cols)
    for spec in (Q.coverage(df), Q.unique_combinations(df, ["iso_code"])):
        with pytest.raises(ValueError, match="not mergeable"):
            Q.check_state(df, [spec])


def test_top_rows_beyond_the_group_limit(spark):
    df = spark.range(20000).select((F.col("id") % 3 == 0).alias("g"), (F.col("id") * 7919 % 1000).alias("v"), "id")
    order = [F.col("v").desc(), F.col("id")]
    got = A.top_n_per_group(df, ["g"], order, n=1500, rn_alias="rn", parts=8)
    rows = {True: [], False: []}
    for r in df.collect():
        rows[r.g].append((-r.v, r.id))
    want = sorted((g, i, k) for g in rows for k, (_, i) in enumerate(sorted(rows[g])[:1500], 1))
    assert sorted((r.g, r.id, r.rn) for r in got.collect()) == want
    # parts are selected first, so the last window gets parts * n rows a group at most
    plan = A.top_n_per_group(df, ["g"], order, n=1500, parts=8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") == 2 and "_q_part" in plan
    small = A.top_n_per_group(df, ["g"], order, n=2)
    assert "WindowGroupLimit" in small._jdf.queryExecution().executedPlan().toString()


def test_counts_come_from_footers(spark):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    found = T.footer_aggregates(spark, f"{SF_SMALL}/lineitem.parquet", ["l_orderkey", "l_linenumber"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(l_orderkey), MAX(l_orderkey), MIN(l_linenumber), MAX(l_linenumber)]" in plan
    li = T.read_table(spark, SF_SMALL, "lineitem")
    want = li.agg(F.count(F.lit(1)), F.min("l_orderkey"), F.max("l_orderkey"), F.min("l_linenumber"), F.max("l_linenumber"))
    assert tuple(found.first()) == tuple(want.first())
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
