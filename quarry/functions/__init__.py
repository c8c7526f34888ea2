"""Column-level helpers, all built on ``pyspark.sql.functions`` (JVM side)."""

from quarry.functions.dates import (
    day_name,
    iso_week,
    minutes_between,
    month_name,
    now_plus_days,
    ts_literal,
)
from quarry.functions.numeric import safe_pct, truncate_count
from quarry.functions.text import CODE_PATTERN, NA_TOKENS, decode_na, matches_code

__all__ = [
    "CODE_PATTERN",
    "NA_TOKENS",
    "day_name",
    "decode_na",
    "iso_week",
    "matches_code",
    "minutes_between",
    "month_name",
    "now_plus_days",
    "safe_pct",
    "truncate_count",
    "ts_literal",
]
