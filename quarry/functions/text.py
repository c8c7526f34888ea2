"""String Column helpers: NA-token decoding and code patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default missing-value tokens of pandas ``read_csv``.  A CSV
# field equal to one of these (exactly, case-sensitive) is read as missing.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Fixed value: a country code is exactly three upper-case ASCII letters.  \A and
# \z anchor the whole string (``$`` would also accept a trailing newline).
CODE_PATTERN = r"\A[A-Z]{3}\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_na(c: Column | str, tokens: tuple[str, ...] = NA_TOKENS) -> Column:
    """NULL when the string equals one of ``tokens``; otherwise unchanged."""
    x = _col(c)
    return F.when(x.isin(*tokens), F.lit(None).cast("string")).otherwise(x)


def matches_code(c: Column | str, pattern: str = CODE_PATTERN) -> Column:
    """True iff the value matches ``pattern``; NULL counts as not matching."""
    return F.coalesce(_col(c).rlike(pattern), F.lit(False))
