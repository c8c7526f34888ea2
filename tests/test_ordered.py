"""Hot-group split windows must equal plain windows, on data where every
group is forced hot (max_group_rows tiny), including ties and NULL keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import ordered
from quarry.operators.ordered import rank_and_lag, sessionize


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_rank_lag_hot_equals_plain(spark):
    data = [(g, (i * 7919) % 23 if i % 11 else None, i) for g in (1, 2) for i in range(300)]
    data += [(3, 5, 1000), (3, 5, 1001)]
    df = spark.createDataFrame(data, "g int, v int, t int")
    got = rank_and_lag(df, ["g"], "v", tie_cols=["t"], max_group_rows=10)
    w_r = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_first())
    w_l = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_first(), "t")
    exp = df.select("*", F.rank().over(w_r).alias("rank"), F.lag("v").over(w_l).alias("prev_value"))
    cols = ["g", "v", "t", "rank", "prev_value"]
    assert _rows(got, cols) == _rows(exp, cols)


def test_rank_lag_plain_path(spark):
    df = spark.createDataFrame([(1, 10, 1), (1, 10, 2), (1, 5, 3), (2, 7, 4)], "g int, v int, t int")
    got = rank_and_lag(df, ["g"], "v", tie_cols=["t"])
    assert _rows(got, ["g", "v", "t", "rank", "prev_value"]) == sorted(
        [(1, 5, 3, 3, 10), (1, 10, 1, 1, None), (1, 10, 2, 1, 10), (2, 7, 4, 1, None)], key=repr
    )


def test_sessionize_hot_equals_plain(spark):
    base = dt.datetime(2024, 1, 15, 9, 0, 0)
    data = []
    for u in (1, 2):
        t = base
        for i in range(400):
            t = t + dt.timedelta(minutes=[5, 31, 30, 0, 97, 2][i % 6], microseconds=(i % 3 == 0))
            data.append((u, t if i % 50 else None, i))
    df = spark.createDataFrame(data, "u int, ts timestamp, k int")
    got = sessionize(df, ["u"], "ts", 30, tie_cols=["k"], max_group_rows=20)
    plain = sessionize(df, ["u"], "ts", 30, tie_cols=["k"])
    cols = ["u", "ts", "k", "gap_minutes", "session_id"]
    assert _rows(got, cols) == _rows(plain, cols)


def test_sessionize_reference_fixture(spark):
    # 7 events of the reference's fixture plus edge rows: a gap of exactly
    # 30 min (same session), 30 min + 1 us (new), a same-time pair, a NULL time.
    t = lambda s: dt.datetime.fromisoformat(s)
    rows = [
        (1, t("2024-01-15 09:00:00"), "page_view", 1),
        (1, t("2024-01-15 09:05:00"), "click", 2),
        (1, t("2024-01-15 09:08:00"), "purchase", 3),
        (1, t("2024-01-15 10:45:00"), "page_view", 4),
        (1, t("2024-01-15 10:50:00"), "click", 5),
        (2, t("2024-01-15 14:00:00"), "page_view", 6),
        (2, t("2024-01-15 14:03:00"), "click", 7),
        (3, t("2024-01-15 08:00:00"), "a", 8),
        (3, t("2024-01-15 08:30:00"), "b", 9),
        (3, t("2024-01-15 09:00:00.000001"), "c", 10),
        (3, t("2024-01-15 09:00:00.000001"), "d", 11),
        (3, None, "e", 12),
    ]
    df = spark.createDataFrame(rows, "user_id int, event_time timestamp, event_type string, k int")
    out = {r["k"]: (r["gap_minutes"], r["session_id"]) for r in sessionize(df, ["user_id"], "event_time", 30, ["k"]).collect()}
    assert out[1] == (None, 1) and out[2] == (5.0, 1) and out[3] == (3.0, 1)
    assert out[4] == (97.0, 2) and out[5] == (5.0, 2)
    assert out[6] == (None, 1) and out[7] == (3.0, 1)
    assert out[9] == (30.0, 1)
    assert out[10][1] == 2 and out[11][1] == 2 and out[11][0] == 0.0
    assert out[12] == (None, 3)


def test_sessionize_ntz_gaps_ignore_session_time_zone(spark):
    # wall-clock gaps of TIMESTAMP_NTZ events across a daylight-saving change
    rows = [(1, dt.datetime(2024, 3, 10, 1, 30), 1), (1, dt.datetime(2024, 3, 10, 3, 30), 2)]
    df = spark.createDataFrame(rows, "u int, ts timestamp_ntz, k int")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        plain = {r.k: (r.gap_minutes, r.session_id) for r in sessionize(df, ["u"], "ts", 30, ["k"]).collect()}
        hot = {r.k: (r.gap_minutes, r.session_id) for r in sessionize(df, ["u"], "ts", 30, ["k"], max_group_rows=1).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert plain == hot == {1: (None, 1), 2: (120.0, 2)}


def test_hot_path_on_driver_tables_equals_plain(spark):
    # most parts and users forced hot: the split path with a probe on the fact
    # alone must give the same rows as the plain windows
    from quarry.plans import driver as D
    from quarry.sources import tables as T
    from tests.conftest import SF_SMALL

    star = D._star(spark, SF_SMALL)
    args = dict(tie_cols=["l_orderkey", "l_linenumber"], rank_alias="r", lag_alias="p")
    hot = rank_and_lag(star, ["l_partkey"], "cases", max_group_rows=25, probe=T.event_facts(spark, SF_SMALL), **args)
    plain = rank_and_lag(star, ["l_partkey"], "cases", **args)
    cols = ["l_orderkey", "l_linenumber", "cases", "r", "p"]
    assert _rows(hot, cols) == _rows(plain, cols)

    ev = T.read_table(spark, SF_SMALL, "events").select("user_id", "ts", "event_id")
    hot_s = sessionize(ev, ["user_id"], "ts", 30, ["event_id"], max_group_rows=5)
    plain_s = sessionize(ev, ["user_id"], "ts", 30, ["event_id"])
    cols = ["event_id", "gap_minutes", "session_id"]
    assert _rows(hot_s, cols) == _rows(plain_s, cols)


def test_single_repeated_value_spans_many_partitions(spark):
    # one hot group, one order value: the peer run crosses every partition
    data = [(1, 7, i) for i in range(500)] + [(1, 3, 1000 + i) for i in range(40)] + [(2, 5, 2000)]
    df = spark.createDataFrame(data, "g int, v int, t int")
    hot = rank_and_lag(df, ["g"], "v", tie_cols=["t"], max_group_rows=7)
    plain = rank_and_lag(df, ["g"], "v", tie_cols=["t"])
    cols = ["g", "v", "t", "rank", "prev_value"]
    assert _rows(hot, cols) == _rows(plain, cols)
    ranks = {r.t: r["rank"] for r in hot.collect()}
    assert ranks[0] == 1 and ranks[499] == 1 and ranks[1000] == 501 and ranks[1039] == 501

    same = dt.datetime(2024, 1, 1, 12, 0)
    ev = spark.createDataFrame(
        [(1, same, i) for i in range(300)] + [(1, None, 900), (1, None, 901), (1, same + dt.timedelta(hours=2), 950)],
        "u int, ts timestamp, k int",
    )
    hot_s = sessionize(ev, ["u"], "ts", 30, ["k"], max_group_rows=5)
    plain_s = sessionize(ev, ["u"], "ts", 30, ["k"])
    cols = ["u", "ts", "k", "gap_minutes", "session_id"]
    assert _rows(hot_s, cols) == _rows(plain_s, cols)


def test_split_equals_plain_on_many_rows_per_range(spark):
    # thousands of rows per range, so range bounds come from a sample: the
    # split reads one written partitioning and two runs agree with the plain window
    from quarry.sources import tables as T

    sf = "/root/testdata/sf0.1"
    ties = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice", "l_partkey"]
    li = T.read_table(spark, sf, "lineitem").select("l_linestatus", F.col("l_quantity").cast("bigint").alias("v"), *ties)
    plain = rank_and_lag(li, ["l_linestatus"], "v", tie_cols=ties, max_group_rows=10_000_000)
    for _ in range(2):
        split = rank_and_lag(li, ["l_linestatus"], "v", tie_cols=ties, max_group_rows=20_000)
        assert split.exceptAll(plain).count() == 0 and split.count() == li.count()
    ev = T.read_table(spark, sf, "events").select("event_type", "ts", "event_id")
    plain_s = sessionize(ev, ["event_type"], "ts", 0.5, ["event_id"], max_group_rows=10_000_000)
    for _ in range(2):
        split_s = sessionize(ev, ["event_type"], "ts", 0.5, ["event_id"], max_group_rows=3_000)
        assert split_s.exceptAll(plain_s).count() == 0 and split_s.count() == ev.count()


def test_many_ranges_are_cut_by_few_tasks(spark, monkeypatch):
    # range partitioning samples in proportion to its partitions, so one
    # partition for each range would send the driver a part of all rows
    written = []

    def kept(df, label):
        written.append(materialize(df, label))
        return written[-1]

    materialize = ordered.materialize
    monkeypatch.setattr(ordered, "materialize", kept)
    rows = spark.range(6000).selectExpr("IF(id % 9 = 0, NULL, id % 2) g", "IF(id % 7 = 0, NULL, id * 7919 % 23) v", "id t")
    ev = rows.selectExpr("g", "timestamp_seconds(v * 600 + t % 5) ts", "t")
    for n, run in enumerate((
        lambda most: rank_and_lag(rows, ["g"], "v", tie_cols=["t"], max_group_rows=most),
        lambda most: sessionize(ev, ["g"], "ts", 9.95, ["t"], max_group_rows=most),
    )):
        split, plain = run(10), run(6000)
        assert split.exceptAll(plain).count() == 0 and split.count() == 6000
        assert len(written) == n + 1 and len(written[n].inputFiles()) <= 64
        order = "g NULLS LAST, " + ("v DESC NULLS FIRST, t" if n == 0 else "ts NULLS LAST, t")
        numbered = written[n].selectExpr("_q_pid", f"row_number() OVER (ORDER BY {order}) i")
        ranges = numbered.groupBy("_q_pid").agg(F.count("i").alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi")).orderBy("_q_pid").collect()
        assert 600 <= len(ranges) <= 664 and max(r.n for r in ranges) == 10
        # gapless runs of the whole order, numbered in that order
        assert [r.lo for r in ranges] == [1, *[r.hi + 1 for r in ranges[:-1]]] and all(r.hi - r.lo + 1 == r.n for r in ranges)
