"""CSV extract (S1-S4): header CSV, projected to the needed columns, pandas'
missing-value tokens decoded to NULL, everything kept as strings until the
clean step parses it (so a malformed number or date fails the run)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import NA_TOKENS, decode_na
from quarry.schemas import RAW_COLUMNS


class MissingColumnsError(ValueError):
    """The source lacks a column the projection needs."""


def csv_options(reader):
    """The reading rules of the feed, for batch and stream readers alike."""
    return (
        reader.option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", False)
    )


def read_csv_projected(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] = RAW_COLUMNS,
    na_tokens: Sequence[str] = NA_TOKENS,
) -> DataFrame:
    """Scan a header CSV and keep ``columns`` only.

    No schema inference: every field is a string (Spark reads only the header
    line to learn the names).  The projection prunes the CSV parser to the
    selected columns (``ReadSchema`` lists just these).  A column absent from
    the header raises ``MissingColumnsError``.  Fields equal to one of
    ``na_tokens`` become NULL, as ``pandas.read_csv`` does by default.

    Quotes inside quoted fields are doubled (RFC 4180).  Of several files each
    must have the header of the first; a file with other or reordered columns
    raises instead of having its values exchanged.  A line with fewer or more
    fields than the header raises, and so does a line break inside a quoted
    field: files are split by lines, and neither occurs in the feed."""
    raw = csv_options(spark.read).option("inferSchema", False).csv(path if isinstance(path, str) else list(path))
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise MissingColumnsError(f"missing columns in {path}: {missing}")
    tokens = tuple(na_tokens)
    return raw.select(*[decode_na(F.col(c), tokens).alias(c) for c in columns])
