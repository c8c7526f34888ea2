"""Calendar and interval Column helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_name(d: Column | str, pad: bool = False) -> Column:
    """'January' ... ; ``pad=True`` blank-pads to 9 characters like the
    ``TO_CHAR(d, 'Month')`` form used by the loader."""
    name = F.date_format(_col(d), "MMMM")
    return F.rpad(name, 9, " ") if pad else name


def day_name(d: Column | str, pad: bool = False) -> Column:
    """'Monday' ... ; ``pad=True`` blank-pads to 9 characters (``TO_CHAR(d, 'Day')``)."""
    name = F.date_format(_col(d), "EEEE")
    return F.rpad(name, 9, " ") if pad else name


def iso_week(d: Column | str) -> Column:
    """ISO-8601 week number (``DATE_PART('week', d)``): 2024-12-01 is week 48,
    2020-12-31 is week 53."""
    return F.weekofyear(_col(d))


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    """``EXTRACT(EPOCH FROM later - earlier) / 60`` as DOUBLE, keeping fractions
    of a second.  Both sides must have the same type; for TIMESTAMP_NTZ this
    is the wall-clock difference whatever the session time zone."""
    return F.timestamp_diff("MICROSECOND", _col(earlier), _col(later)) / F.lit(60_000_000.0)


def ts_literal(value: _dt.datetime | _dt.date) -> Column:
    """A TIMESTAMP_NTZ literal with exactly the given wall-clock value,
    independent of the Python process's and the session's time zones."""
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def now_plus_days(now: _dt.datetime | Column, days: int) -> Column:
    """``now + N days`` with ``now`` injectable (a literal taken once)."""
    base = now if isinstance(now, Column) else ts_literal(now)
    return base + F.make_dt_interval(F.lit(days))
