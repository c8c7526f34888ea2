"""Numeric Column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_pct(numerator: Column | str, denominator: Column | str, scale: int = 2, fractional: bool = False) -> Column:
    """``ROUND(num::NUMERIC / NULLIF(den, 0) * 100, scale)``, exact.

    NULL when the denominator is 0 or NULL (ANSI Spark would raise on x/0).
    Operands are DECIMAL: whole numbers of the full BIGINT range, or with
    ``fractional`` up to six decimals.  The numerator is multiplied by 100
    *before* dividing, since dividing first keeps only six decimals of the
    quotient and can round 0.00499.. up to 0.01.  Rounding is half away from
    zero, as NUMERIC rounding is.  Returned as DOUBLE (the 2-dp decimal,
    widened)."""
    kind = "decimal(25,6)" if fractional else "decimal(19,0)"
    num = _col(numerator).cast(kind) * F.lit(100).cast("decimal(3,0)")
    den = F.nullif(_col(denominator).cast(kind), F.lit(0).cast(kind))
    return F.round(num / den, scale).cast("double")


def truncate_count(c: Column | str, fill: float = 0.0) -> Column:
    """Null/NaN -> ``fill`` then truncate toward zero to BIGINT (pandas
    ``fillna(0).astype(int)``).  ANSI casts raise on +-inf / overflow."""
    x = _col(c).cast("double")
    x = F.when(x.isNull() | F.isnan(x), F.lit(fill)).otherwise(x)
    return x.cast("bigint")
