"""Cleaning chain of the raw extract (C1 = F1 -> F2 -> F3 -> parse date -> F4
-> P1 -> P2 -> P3), one lazy plan with no actions.

Order matters: counts are filled and truncated *before* the sign filter, so a
-0.5 becomes 0 and is kept while -50 is dropped."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quarry.functions.dates import ts_literal
from quarry.functions.numeric import truncate_count

# The extract's columns renamed to staging names, and the source
# tag written on every staged row.
DEFAULT_SOURCE_NAME = "Our World in Data"
DEFAULT_RENAME = {
    "iso_code": "iso_code",
    "location": "country",
    "date": "event_date",
    "new_cases": "cases",
    "new_deaths": "deaths",
}


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """drop rows with NULL in any of ``cols``."""
    return df.na.drop("any", subset=list(cols))


def keep_code_length(df: DataFrame, col: str, length: int = 3) -> DataFrame:
    """keep rows whose code has exactly ``length`` characters (NULL drops)."""
    return df.where(F.length(F.col(col)) == F.lit(length))


def fill_and_truncate(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL/NaN -> 0, then truncate toward zero to BIGINT.  The string to
    number parse is strict under ANSI: a non-number raises."""
    return df.withColumns({c: truncate_count(F.col(c)) for c in cols})


def parse_timestamp(df: DataFrame, col: str) -> DataFrame:
    """String -> TIMESTAMP_NTZ; a malformed value raises under ANSI."""
    return df.withColumn(col, F.to_timestamp_ntz(F.col(col)))


def keep_non_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """keep rows where every column is >= 0."""
    cond: Column | None = None
    for c in cols:
        term = F.col(c) >= F.lit(0)
        cond = term if cond is None else cond & term
    return df.where(cond) if cond is not None else df


def keep_recent(df: DataFrame, col: str, now: dt.datetime, days: int | None) -> DataFrame:
    """keep the last ``days`` days before ``now`` (no-op when ``days`` is
    None, which is how the reference pipeline runs)."""
    if days is None:
        return df
    cutoff = ts_literal(now) - F.make_dt_interval(F.lit(days))
    return df.where(F.col(col) >= cutoff)


def _observe(df: DataFrame, observations: dict[str, Observation] | None, stage: str) -> DataFrame:
    """Count rows after a stage without an extra job (filled in by
    whatever action later runs the plan)."""
    if observations is None:
        return df
    obs = Observation(f"rows_after_{stage}")
    observations[stage] = obs
    return df.observe(obs, F.count(F.lit(1)).alias("rows"))


def clean_events(
    df: DataFrame,
    run_ts: dt.datetime,
    key_cols: Sequence[str] = ("iso_code", "location", "date"),
    code_col: str = "iso_code",
    code_length: int = 3,
    measures: Sequence[str] = ("new_cases", "new_deaths"),
    date_col: str = "date",
    rename: Mapping[str, str] = DEFAULT_RENAME,
    source_name: str = DEFAULT_SOURCE_NAME,
    since_days: int | None = None,
    observations: dict[str, Observation] | None = None,
) -> DataFrame:
    """The whole cleaning chain.  ``run_ts`` is taken once by the caller and
    written as a literal (``current_timestamp()`` would change per action)."""
    out = _observe(df, observations, "extract")
    out = _observe(drop_incomplete(out, key_cols), observations, "drop_nulls")
    out = _observe(keep_code_length(out, code_col, code_length), observations, "code_length")
    out = fill_and_truncate(out, measures)
    out = parse_timestamp(out, date_col)
    out = _observe(keep_non_negative(out, measures), observations, "non_negative")
    out = keep_recent(out, date_col, run_ts, since_days)
    out = out.withColumnsRenamed({k: v for k, v in rename.items() if k != v})
    out = out.withColumn("source_name", F.lit(source_name))
    out = out.withColumn("loaded_at", ts_literal(run_ts))
    return out
