"""Windows over ordered groups (RANK/LAG, sessionisation) that stay
distributed when a single group is hot.

A plain ``Window.partitionBy(g)`` sends every row of a group to one task; if
one group holds a third of all rows, one task sorts a third of the data.

Here one count finds the size of the largest group (on ``probe``, e.g. the
fact before its dimension joins).  If it is at most ``max_group_rows``, the
plain window runs.  Otherwise all rows go through one segmented scan: they are
range-partitioned once on the *whole* sort order ``(group, order key, tie
columns)`` and sorted, and every task numbers its rows and cuts them into
ranges of at most ``max_group_rows``, so even a single repeated order value is
split and small groups share a range.  Range partitioning sends the driver a
sample in proportion to its tasks, so their number follows the rows, not the
number of ranges.  The rows, each tagged with its range, are written once:
task bounds come from a sample, so every later step must read the same ranges
instead of evaluating them again.  Each (group, range) is windowed locally,
and a summary of the groups that span several ranges supplies what crosses
their borders:

- the global row number offset (rows of the group in earlier ranges);
- the previous row's value (for LAG and for session gaps);
- where the run of equal order values that a range starts with began
  (RANK = global row number of the first peer);
- session-flag offsets and each group's flag total.

At most two groups cross each border, so that summary has a few rows per range
whatever the number of groups.  Results equal the plain window (tests and two
registered queries force every group hot, with thousands of rows per range)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.dates import minutes_between
from quarry.session import materialize

# Rows a single window task may own before its group is split.
DEFAULT_MAX_GROUP_ROWS = 4_000_000

# Ranges are cut by tasks of about so many rows, at least so many tasks (where
# there are as many ranges): the driver gets some 300 sampled sort keys a task.
_TASK_ROWS = 500_000
_MIN_TASKS = 64

# A range's number: that of its first row in the order of (task, row of the task).
_PID = "_q_pid"
_TASK_ROW_BITS = (1 << 33) - 1  # of monotonically_increasing_id


def _group_sizes(src: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest group of ``src``, and of all groups."""
    counts = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_q_n"))
    largest, total = counts.agg(F.max("_q_n"), F.sum("_q_n")).first()
    return int(largest or 0), int(total or 0)


def _null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``on`` where NULL keys match (a NULL group is a group)."""
    renamed = right.select(*[F.col(c).alias(f"_q_r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_q_r_{c}"]) for c in on])
    return left.join(renamed, cond, how).drop(*[f"_q_r_{c}" for c in on])


def _range_partitioned(rows: DataFrame, keys: Sequence[str], sort: Sequence[Column], total: int, max_rows: int) -> DataFrame:
    """Tag rows with ranges of at most ``max_rows`` rows that follow the order
    of (keys, sort...); ``total`` is about the number of rows.  The tagged rows
    are written once and read back."""
    size = max(1, max_rows)
    tasks = min(math.ceil(total / size), max(_MIN_TASKS, math.ceil(total / _TASK_ROWS)))
    order = [*[F.col(k).asc_nulls_last() for k in keys], *sort]
    numbered = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn(_PID, F.monotonically_increasing_id())
    first = F.col(_PID) - F.col(_PID).bitwiseAND(F.lit(_TASK_ROW_BITS)) % F.lit(size)
    tagged = materialize(numbered.withColumn(_PID, first), "ranges")
    # The windows cluster by (keys, range).  Hashing the range alone satisfies
    # that, so they add no exchange of their own.
    return tagged.repartition(F.col(_PID))


def _spanning(summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a (group, range) summary whose group has several ranges."""
    ranges = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return summary.withColumn("_q_ranges", ranges).where("_q_ranges > 1").drop("_q_ranges")


def _sort_key(c: Column, descending: bool, nulls_first: bool) -> Column:
    if descending:
        return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()
    return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()


def _plain_rank_lag(df, keys, o, key, ties, rank_alias, lag_alias, cols):
    w_rank = Window.partitionBy(*keys).orderBy(key)
    w_lag = Window.partitionBy(*keys).orderBy(key, *ties)
    # LAG's window (the longer sort key) is planned first; RANK's ordering is
    # a prefix of it, so both windows share one exchange and one sort.
    with_lag = df.withColumn(lag_alias, F.lag(o).over(w_lag))
    return with_lag.withColumn(rank_alias, F.rank().over(w_rank).cast("bigint")).select(
        *cols, rank_alias, lag_alias
    )


def rank_and_lag(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_col: str,
    tie_cols: Sequence[str] = (),
    descending: bool = True,
    nulls_first: bool | None = None,
    rank_alias: str = "rank",
    lag_alias: str = "prev_value",
    max_group_rows: int = DEFAULT_MAX_GROUP_ROWS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """``RANK() OVER (PARTITION BY p ORDER BY o)`` and ``LAG(o)`` over the same
    window.  RANK orders by ``o`` alone (peers share a rank); LAG adds
    ``tie_cols`` so ties resolve the same way on every run.  NULL placement
    defaults to PostgreSQL's: first for DESC, last for ASC."""
    if nulls_first is None:
        nulls_first = descending
    keys = list(partition_cols)
    cols = df.columns
    o = F.col(order_col)
    key = _sort_key(o, descending, nulls_first)
    ties = [F.col(t).asc_nulls_last() for t in tie_cols]
    largest, total = _group_sizes(df if probe is None else probe, keys)
    if largest <= max_group_rows:
        return _plain_rank_lag(df, keys, o, key, ties, rank_alias, lag_alias, cols)

    ranged = _range_partitioned(df, keys, [key, *ties], total, max_group_rows)
    kp = [*keys, _PID]
    w_rows = Window.partitionBy(*kp).orderBy(key, *ties)
    w_vals = Window.partitionBy(*kp).orderBy(key)
    local = ranged.withColumn("_q_lrn", F.row_number().over(w_rows)).withColumn(
        "_q_llag", F.lag(o).over(w_rows)
    )
    # local position of the first row with this value (rows are in value order)
    local = local.withColumn("_q_lfirst", F.rank().over(w_vals))
    summary = local.groupBy(*kp).agg(
        F.count(F.lit(1)).alias("_q_n"),
        F.min_by(o, F.col("_q_lrn")).alias("_q_first"),
        F.max_by(o, F.col("_q_lrn")).alias("_q_last"),
        F.max_by(F.col("_q_lfirst"), F.col("_q_lrn")).alias("_q_last_first"),
    )
    summary = _spanning(summary, keys)
    by_pid = Window.partitionBy(*keys).orderBy(_PID)
    summary = (
        summary.withColumn(
            "_q_off",
            F.coalesce(F.sum("_q_n").over(by_pid.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .withColumn("_q_prev_last", F.lag("_q_last").over(by_pid))
        .withColumn("_q_has_prev", F.lag(_PID).over(by_pid).isNotNull())
        # global row number of the first row of this partition's last value
        .withColumn("_q_start_last", F.col("_q_off") + F.col("_q_last_first"))
    )
    # partitions sharing a last value are contiguous, so the earliest start in
    # that run is where the value's rows begin
    run = Window.partitionBy(*keys, "_q_last").orderBy(_PID).rowsBetween(Window.unboundedPreceding, 0)
    summary = summary.withColumn("_q_run_start", F.min("_q_start_last").over(run))
    summary = summary.withColumn("_q_prev_run_start", F.lag("_q_run_start").over(by_pid))
    continues = F.col("_q_has_prev") & F.col("_q_prev_last").eqNullSafe(F.col("_q_first"))
    offsets = summary.select(
        *kp,
        "_q_off",
        "_q_first",
        "_q_prev_last",
        F.when(continues, F.col("_q_prev_run_start"))
        .otherwise(F.col("_q_off") + F.lit(1))
        .alias("_q_first_rank"),
    )
    joined = _null_safe_join(local, offsets, kp, "left")
    rank = (
        F.when(F.col("_q_off").isNull(), F.col("_q_lfirst"))  # a group within one range
        .when(o.eqNullSafe(F.col("_q_first")), F.col("_q_first_rank"))
        .otherwise(F.col("_q_off") + F.col("_q_lfirst"))
    )
    lag = F.when(F.col("_q_lrn") == 1, F.col("_q_prev_last")).otherwise(F.col("_q_llag"))
    return joined.select(*cols, rank.cast("bigint").alias(rank_alias), lag.alias(lag_alias))


def _plain_sessions(df, keys, ts, key, ties, flag, gap_alias, session_alias, cols):
    w_lag = Window.partitionBy(*keys).orderBy(key, *ties)
    w_sum = Window.partitionBy(*keys).orderBy(key)
    gapped = df.withColumn(gap_alias, minutes_between(ts, F.lag(ts).over(w_lag)))
    return gapped.withColumn(
        session_alias, F.sum(flag(F.col(gap_alias))).over(w_sum).cast("bigint")
    ).select(*cols, gap_alias, session_alias)


def sessionize(
    df: DataFrame,
    user_cols: Sequence[str],
    ts_col: str,
    gap_minutes: float = 30.0,
    tie_cols: Sequence[str] = (),
    gap_alias: str = "gap_minutes",
    session_alias: str = "session_id",
    max_group_rows: int = DEFAULT_MAX_GROUP_ROWS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Row-preserving sessionisation.

    ``gap = minutes since the previous event of the user`` (LAG over time
    ascending, NULL times last); a row opens a session when ``gap > gap_minutes``
    (strictly) or gap is NULL; ``session_id`` is the running SUM of those
    flags over the *default* RANGE frame, so events at the same time share an
    id.  ``tie_cols`` only fix which of several same-time events LAG sees first."""
    keys = list(user_cols)
    cols = df.columns
    ts = F.col(ts_col)
    key = ts.asc_nulls_last()
    ties = [F.col(t).asc_nulls_last() for t in tie_cols]
    thr = F.lit(float(gap_minutes))

    def flag(gap: Column) -> Column:
        return F.when((gap > thr) | gap.isNull(), F.lit(1)).otherwise(F.lit(0))

    largest, total = _group_sizes(df if probe is None else probe, keys)
    if largest <= max_group_rows:
        return _plain_sessions(df, keys, ts, key, ties, flag, gap_alias, session_alias, cols)

    ranged = _range_partitioned(df, keys, [key, *ties], total, max_group_rows)
    kp = [*keys, _PID]
    w_rows = Window.partitionBy(*kp).orderBy(key, *ties)
    local = ranged.withColumn("_q_lrn", F.row_number().over(w_rows)).withColumn(
        "_q_lprev", F.lag(ts).over(w_rows)
    )
    # the first row of a partition sees no previous row and is flagged 1 here;
    # the summary corrects it from the previous partition's last time
    local = local.withColumn("_q_lflag", flag(minutes_between(ts, F.col("_q_lprev"))))
    local = local.withColumn(
        "_q_lsum", F.sum("_q_lflag").over(w_rows.rowsBetween(Window.unboundedPreceding, 0))
    )
    local = local.withColumn("_q_ltotal", F.sum("_q_lflag").over(Window.partitionBy(*kp)))
    summary = local.groupBy(*kp).agg(
        F.min_by(ts, F.col("_q_lrn")).alias("_q_first"),
        F.max_by(ts, F.col("_q_lrn")).alias("_q_last"),
        F.sum("_q_lflag").alias("_q_lflags"),
    )
    summary = _spanning(summary, keys)
    by_pid = Window.partitionBy(*keys).orderBy(_PID)
    summary = summary.withColumn("_q_prev_last", F.lag("_q_last").over(by_pid)).withColumn(
        "_q_has_prev", F.lag(_PID).over(by_pid).isNotNull()
    )
    f0 = F.when(~F.col("_q_has_prev"), F.lit(1)).otherwise(
        flag(minutes_between(F.col("_q_first"), F.col("_q_prev_last")))
    )
    summary = summary.withColumn("_q_f0", f0).withColumn(
        "_q_flags", F.col("_q_lflags") - F.lit(1) + F.col("_q_f0")
    )
    offsets = summary.select(
        *kp,
        "_q_prev_last",
        "_q_f0",
        F.coalesce(
            F.sum("_q_flags").over(by_pid.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_q_off"),
        # NULL times are peers of each other and come last: their RANGE sum
        # is the group's total
        F.sum("_q_flags").over(Window.partitionBy(*keys)).alias("_q_total"),
    )
    joined = _null_safe_join(local, offsets, kp, "left")
    prev = F.when(F.col("_q_lrn") == 1, F.col("_q_prev_last")).otherwise(F.col("_q_lprev"))
    # For non-NULL times only the first of several same-time events can carry
    # a flag, so the ROWS running sum equals the RANGE (peer) sum.
    whole = F.col("_q_off").isNull()  # a group within one range
    running = F.when(whole, F.col("_q_lsum")).otherwise(F.col("_q_off") + F.col("_q_lsum") - (F.lit(1) - F.col("_q_f0")))
    of_null = F.when(whole, F.col("_q_ltotal")).otherwise(F.col("_q_total"))
    session = F.when(ts.isNull(), of_null).otherwise(running)
    return joined.select(
        *cols, minutes_between(ts, prev).alias(gap_alias), session.cast("bigint").alias(session_alias)
    )
