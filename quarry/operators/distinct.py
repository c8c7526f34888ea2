"""Exact distinct counts that can be merged.

``COUNT(DISTINCT ...)`` has to see all rows again for every new load and every
coarser grouping.  Here the ids of a group are kept as bitmaps, one row of up
to 32,768 ids each, which are combined by OR: over loads, and over groups.
Ids are integers, best the dense surrogate keys of a dimension; texts are
counted through theirs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLOCK, _BITS = "id_block", "id_bits"


def distinct_state(rows: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Bitmaps of the ids of each group: ``keys, id_block, id_bits``.  NULL ids
    are not counted (a group with no other has no row); a NULL key is a group.
    Bitmaps are filled map-side, so a hot group shuffles a few of them."""
    ids = rows.where(F.col(id_col).isNotNull()).select(*keys, F.col(id_col).cast("bigint").alias("_q_id"))
    placed = ids.select(*keys, F.bitmap_bucket_number("_q_id").alias(_BLOCK), F.bitmap_bit_position("_q_id").alias("_q_bit"))
    return placed.groupBy(*keys, _BLOCK).agg(F.bitmap_construct_agg("_q_bit").alias(_BITS))


def merge_states(states: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """States of several loads, or one state at coarser ``keys``, as one."""
    both = reduce(DataFrame.unionByName, [s.select(*keys, _BLOCK, _BITS) for s in states])
    return both.groupBy(*keys, _BLOCK).agg(F.bitmap_or_agg(_BITS).alias(_BITS))


def distinct_counts(state: DataFrame, keys: Sequence[str], alias: str = "distinct_ids") -> DataFrame:
    """The exact number of different ids of each group at ``keys``, which may
    be fewer than the state's own (none: of all rows)."""
    merged = merge_states([state], keys)
    count = F.coalesce(F.sum(F.bitmap_count(_BITS)), F.lit(0)).cast("bigint").alias(alias)
    return merged.groupBy(*keys).agg(count) if keys else merged.agg(count)
