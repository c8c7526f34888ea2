"""CSV files whose quoted fields hold line breaks, read by byte ranges.

Spark's ``multiLine`` CSV scan reads such a file in one task.  Here the files
are read as lines, several tasks a file, and records are put together from the
parity of quotes: a line starts a record if an even number of quotes precedes
it in its file.  The parity before each byte range (block) comes from a prefix
sum over one small row per block, the parity inside a block from a running sum,
so no task holds more than a block.  Only the lines of records that span
several lines are grouped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.functions.text import NA_TOKENS, decode_na
from quarry.schemas import RAW_COLUMNS
from quarry.sources.csv import MissingColumnsError, csv_options


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file, block, pos, line, quotes``; ``pos`` ascends within a block."""
    text = spark.read.option("lineSep", "\n").text(paths)
    line = F.col("value")
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        line.alias("line"),
        (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))).cast("bigint").alias("quotes"),
    )


def _blocks(lines: DataFrame) -> DataFrame:
    """Per block: the parity of quotes before it, and the block that holds the
    start of the record open there."""
    totals = lines.groupBy("file", "block").agg(F.sum("quotes").alias("q"), F.max(F.col("quotes") % 2).alias("turns"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parity = F.coalesce(F.sum("q").over(before), F.lit(0)) % 2
    known = totals.select("file", "block", "turns", parity.alias("inside"))
    # a block that begins inside a field and never leaves it starts no record
    starts = F.when((F.col("inside") == 0) | (F.col("turns") == 1), F.col("block"))
    return known.select("file", "block", "inside", F.last(starts, True).over(before).alias("open_block"))


def read_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``record, first`` for every record of the files; ``first`` marks the
    first one of each file.  Blank lines between records are no records."""
    lines = _lines(spark, [path] if isinstance(path, str) else list(path))
    order = Window.partitionBy("file", "block").orderBy("pos")
    before = F.coalesce(F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = lines.join(_blocks(lines).hint("shuffle_hash"), ["file", "block"])
    rows = rows.withColumn("starts", ((F.col("inside") + before) % 2 == 0).cast("int"))
    rows = rows.withColumn("number", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.max("number").over(Window.partitionBy("file", "block"))
    open_end = ((F.col("inside") + F.sum("quotes").over(Window.partitionBy("file", "block"))) % 2 == 1)
    rows = rows.withColumn("number_in", F.when(open_end & (F.col("number") == last), F.lit(-1)).otherwise(F.col("number")))
    head = F.col("number") == 0  # continues a record of an earlier block
    rows = rows.select(
        "file", "pos", "block", "line",
        F.when(head, F.col("open_block")).otherwise(F.col("block")).alias("at"),
        F.when(head, F.lit(-1)).otherwise(F.col("number_in")).alias("of"),
        ((F.col("block") == 0) & (F.col("number") == 1)).alias("first"),
        ((F.col("starts") == 1) & (F.col("quotes") % 2 == 0)).alias("whole"),
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "pos", "line")))
    joined = rows.where("NOT whole").groupBy("file", "at", "of").agg(
        F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("record"), F.max("first").alias("first")
    )
    every = rows.where("whole").select(F.col("line").alias("record"), "first").unionByName(joined.select("record", "first"))
    return every.withColumn("record", F.regexp_replace("record", "\r\\z", "")).where("record <> ''")


def read_csv_records(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] = RAW_COLUMNS,
    na_tokens: Sequence[str] = NA_TOKENS,
) -> DataFrame:
    """``read_csv_projected`` for files with line breaks in quoted fields.

    As in a projecting ``pandas.read_csv``, fields missing at the end of a line
    are NULL, fields beyond the header are dropped and blank lines skipped.  A
    file whose header differs from the first one's raises.  Quotes belong around whole fields and are
    doubled inside (RFC 4180): a single quote inside an unquoted field would
    turn the parity of what follows.  A header is one line."""
    names = csv_options(spark.read).csv(path if isinstance(path, str) else list(path)).columns
    missing = [c for c in columns if c not in names]
    if missing:
        raise MissingColumnsError(f"missing columns in {path}: {missing}")
    tokens = tuple(na_tokens)
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in names)
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    rows = read_records(spark, path).select("first", F.from_csv("record", schema, options).alias("row"))
    same = F.array(*[F.col("row")[c] for c in names]) == F.array(*[F.lit(c) for c in names])
    wrong_header = F.raise_error("a CSV file has another header than the first").cast("boolean")
    kept = F.when(~F.col("first"), True).otherwise(F.when(F.coalesce(same, F.lit(False)), False).otherwise(wrong_header))
    return rows.where(kept).select(*[decode_na(F.col("row")[c], tokens).alias(c) for c in columns])
