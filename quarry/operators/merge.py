"""Dimension loads: insert-new-only (L2, L3, J6) and upsert.

These re-aim ``INSERT ... ON CONFLICT (key) DO NOTHING`` and ``... DO UPDATE
SET col = EXCLUDED.col`` on Parquet tables, which have neither unique
constraints nor MERGE: the new rows (or the merged table) are computed as a
DataFrame and then appended / published as a new version by the warehouse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.keys import assign_keys, max_id
from quarry.session import materialize


class DuplicateKeyError(ValueError):
    """An upsert batch holds the same key twice (``ON CONFLICT DO UPDATE``
    cannot affect a row a second time)."""


def _key_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key.  Which duplicate wins is unspecified in the reference;
    here it is the smallest whole row (``min(struct(...))``), so reruns agree.
    A hot key is reduced map-side by the partial aggregate."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    best = F.min(F.struct(*[F.col(c) for c in others])).alias("_q_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_q_best.{c}").alias(c) for c in others])


def new_rows(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    id_col: str,
    order_cols: Sequence[str] | None = None,
    start_after: int | None = None,
) -> DataFrame:
    """Rows of ``incoming`` (deduplicated on ``keys``, NULL keys skipped) whose
    key is not in ``existing``, with fresh ids in ``order_cols`` order
    (default: the keys) above ``start_after`` (default: the existing maximum).

    The batch is written once.  Which of its keys are known is found by a
    semi join that streams the existing keys past the batch, so while the
    batch measures small ``existing`` is scanned but not shuffled."""
    batch = materialize(first_per_key(incoming.where(_key_not_null(keys)), keys), "batch")
    known = existing.select(*keys).join(batch.select(*keys), list(keys), "left_semi")
    fresh = batch.join(known, list(keys), "left_anti")
    mark = max_id(existing, id_col) if start_after is None else start_after
    return assign_keys(fresh, id_col, order_cols or keys, start_after=mark)


def insert_new(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    id_col: str,
    order_cols: Sequence[str] | None = None,
) -> DataFrame:
    """The whole dimension after ``INSERT ... ON CONFLICT DO NOTHING``.  Running
    it again with the same input changes nothing."""
    added = new_rows(existing, incoming, keys, id_col, order_cols)
    return existing.unionByName(added.select(*existing.columns))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-NULL keys that occur more than once, with their row counts."""
    return df.where(_key_not_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def check_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a non-NULL key occurs twice in the batch."""
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"key {tuple(dup[0][k] for k in keys)} occurs more than once in the batch")


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    id_col: str,
    order_cols: Sequence[str] | None = None,
    start_after: int | None = None,
) -> DataFrame:
    """The whole dimension after ``INSERT ... ON CONFLICT (keys) DO UPDATE SET
    c = EXCLUDED.c`` for ``c`` in ``update_cols``.

    Matched rows keep their id and every other column, and take the incoming
    value of ``update_cols`` even when it is NULL.  Unmatched incoming rows
    (including every row with a NULL key, which never conflicts) are inserted
    with new ids.  Existing rows without a match are kept."""
    check_unique_keys(incoming, keys)
    cols = existing.columns
    payload = [c for c in cols if c != id_col and c not in keys]
    inc = incoming.select(*keys, *[F.col(c).alias(f"_q_in_{c}") for c in payload]).withColumn(
        "_q_in", F.lit(True)
    )
    ex = existing.withColumn("_q_ex", F.lit(True))
    joined = ex.join(inc.where(_key_not_null(keys)), list(keys), "full_outer")
    matched = F.col("_q_in").isNotNull()
    kept = joined.where(F.col("_q_ex").isNotNull()).select(
        *[
            (F.when(matched, F.col(f"_q_in_{c}")).otherwise(F.col(c)) if c in update_cols else F.col(c)).alias(c)
            for c in cols
        ]
    )
    unmatched = joined.where(F.col("_q_ex").isNull()).select(
        *keys, *[F.col(f"_q_in_{c}").alias(c) for c in payload]
    )
    null_keyed = incoming.where(~_key_not_null(keys)).select(*keys, *payload)
    added = assign_keys(
        unmatched.unionByName(null_keyed),
        id_col,
        order_cols or keys,
        start_after=max_id(existing, id_col) if start_after is None else start_after,
    )
    return kept.unionByName(added.select(*cols))
