"""Sessionisation carried across loads (C8, W4-W6 in increments).

A state table keeps one row per user: the time of the last event and the
number of sessions so far.  Of a new load only the new events are windowed;
the state's rows join in as one earlier event per user, so the first gap of
each user and the running session number continue where the last load ended.
Nothing of the history is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordered import DEFAULT_MAX_GROUP_ROWS, sessionize

LAST_TIME = "last_time"
SESSIONS = "sessions"


class LateEventsError(ValueError):
    """A load holds events earlier than what was already sessionised."""


def _matches(left: DataFrame, state: DataFrame, user_cols: Sequence[str], how: str) -> DataFrame:
    """Join on the user columns, where a NULL user is a user like any other."""
    named = state.select(*[F.col(c).alias(f"_q_u_{c}") for c in user_cols], LAST_TIME, SESSIONS)
    on = F.lit(True)
    for c in user_cols:
        on = on & left[c].eqNullSafe(named[f"_q_u_{c}"])
    return left.join(named, on, how).drop(*[f"_q_u_{c}" for c in user_cols])


def late_events(events: DataFrame, state: DataFrame, user_cols: Sequence[str], ts_col: str) -> DataFrame:
    """Events before the last one that their user's state knows."""
    joined = _matches(events, state, user_cols, "inner")
    return joined.where(F.col(ts_col) < F.col(LAST_TIME)).select(*events.columns)


def sessionize_load(
    events: DataFrame,
    state: DataFrame | None,
    user_cols: Sequence[str],
    ts_col: str,
    gap_minutes: float = 30.0,
    tie_cols: Sequence[str] = (),
    gap_alias: str = "gap_minutes",
    session_alias: str = "session_id",
    max_group_rows: int = DEFAULT_MAX_GROUP_ROWS,
) -> DataFrame:
    """``events`` with gap and session number, as ``sessionize`` over all loads
    so far would number them.  ``state`` is what ``session_state`` returned
    after the last load (None for the first one).

    An event at its user's last known time belongs to that session.  Earlier
    ones would change numbers already given, so they raise ``LateEventsError``
    (``late_events`` lists them).  An event without a time comes after all
    others of its user, whichever load they are in, so it cannot be numbered
    yet: its gap and session are NULL and the state does not know it."""
    timed = events.where(F.col(ts_col).isNotNull())
    order = "_q_known"
    ties = [order, *tie_cols]
    if state is None:
        rows = timed.withColumn(order, F.lit(1))
    else:
        if not late_events(timed, state, user_cols, ts_col).isEmpty():
            raise LateEventsError("events precede what was already sessionised")
        # only users of this load are looked at
        users = timed.select(*user_cols).distinct()
        before = _matches(users, state, user_cols, "inner").select(*user_cols, F.col(LAST_TIME).alias(ts_col), F.lit(0).alias(order))
        rows = timed.withColumn(order, F.lit(1)).unionByName(before, allowMissingColumns=True)
    numbered = sessionize(rows, user_cols, ts_col, gap_minutes, ties, gap_alias, session_alias, max_group_rows)
    out = numbered.where(F.col(order) == 1).drop(order)
    if state is not None:
        # the state's row opened session 1 of this load, the user's latest one
        out = _matches(out, state, user_cols, "left")
        number = F.col(session_alias) + F.coalesce(F.col(SESSIONS) - 1, F.lit(0))
        out = out.withColumn(session_alias, number.cast("bigint")).drop(LAST_TIME, SESSIONS)
    untimed = events.where(F.col(ts_col).isNull())
    return out.unionByName(untimed.withColumn(gap_alias, F.lit(None).cast("double")).withColumn(session_alias, F.lit(None).cast("bigint")))


def session_state(
    sessions: DataFrame, state: DataFrame | None, user_cols: Sequence[str], ts_col: str, session_alias: str = "session_id"
) -> DataFrame:
    """The state after a load: the load's users as ``sessions`` (the result of
    ``sessionize_load``) leaves them, all others as they were."""
    timed = sessions.where(F.col(ts_col).isNotNull())
    rows = timed.groupBy(*user_cols).agg(F.max(ts_col).alias(LAST_TIME), F.max(session_alias).alias(SESSIONS))
    if state is None:
        return rows
    both = state.select(*user_cols, LAST_TIME, SESSIONS).unionByName(rows)
    return both.groupBy(*user_cols).agg(F.max(LAST_TIME).alias(LAST_TIME), F.max(SESSIONS).alias(SESSIONS))
