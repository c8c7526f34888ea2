"""Surrogate keys (L4: the re-aim of SERIAL).

Dimensions: dense ids ``base+1, base+2, ...`` in the order of a natural key.
There is one path for every size and no global window over rows (which would
pull them into one task): rows are range-partitioned and sorted on the key,
each partition numbers its rows locally, and a per-partition count table gives
each partition its offset.  The numbered frame is written once first, so the
ids can never change on re-evaluation.

Facts: ids only need to be unique and above the previous high-water mark, so
``monotonically_increasing_id`` is enough (gaps allowed, as with SERIAL)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize


def max_id(existing: DataFrame | None, id_col: str) -> int:
    """High-water mark of an id column (0 for a missing or empty table)."""
    if existing is None:
        return 0
    value = existing.agg(F.max(F.col(id_col))).first()[0]
    return int(value) if value is not None else 0


def assign_keys(
    df: DataFrame,
    id_col: str,
    order_cols: Sequence[str],
    start_after: int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``id_col`` = ``start_after + 1 .. start_after + n`` following
    ``order_cols`` (ascending, NULLs last).  Rows that tie there, such as rows
    with NULL keys, are ordered by all their other columns, so equal inputs
    get equal ids; only rows equal in every column are interchangeable."""
    rest = [c for c in df.columns if c not in order_cols]
    order = [F.col(c).asc_nulls_last() for c in [*order_cols, *rest]]
    # Without an explicit count AQE sizes the range partitions; coalescing
    # only merges adjacent ranges, in order, so partition ids still follow
    # the key order.
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    numbered = (
        ranged
        .sortWithinPartitions(*order)
        .withColumn("_q_pid", F.spark_partition_id())
        # the lower 33 bits of monotonically_increasing_id are the row's
        # position inside its partition, which here follows the sort order
        .withColumn("_q_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    numbered = materialize(numbered, "keys")
    counts = numbered.groupBy("_q_pid").agg(F.count(F.lit(1)).alias("_q_n"))
    # one row per partition, so this window is bounded by the partition count
    before = Window.orderBy("_q_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_q_pid", F.coalesce(F.sum("_q_n").over(before), F.lit(0)).alias("_q_off")
    )
    return numbered.join(offsets, "_q_pid").select(
        *df.columns,
        (F.lit(start_after) + F.col("_q_off") + F.col("_q_pos") + F.lit(1)).cast("bigint").alias(id_col),
    )


def assign_fact_ids(df: DataFrame, id_col: str, start_after: int = 0) -> DataFrame:
    """Unique, increasing (not dense) ids above ``start_after``.  Write the
    result in the same action that computes it; never reuse it lazily."""
    return df.withColumn(
        id_col, (F.lit(start_after) + F.monotonically_increasing_id() + F.lit(1)).cast("bigint")
    )
