"""Fact load (L5, L6, L9, J4, J5, F7, P4) and the referential checks around it
(T13, T15)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quarry.functions.dates import ts_literal
from quarry.operators.keys import assign_fact_ids, max_id
from quarry.operators.merge import first_per_key
from quarry.schemas import FACT_NATURAL_KEY
from quarry.session import materialize

FACT_COLUMNS = (
    "date_id",
    "location_id",
    "disease_id",
    "source_id",
    "cases",
    "deaths",
    "recovered",
    "loaded_at",
)


def _keyed(staging: DataFrame, dim_date: DataFrame, dim_location: DataFrame) -> DataFrame:
    # The join key is an expression (event_date::DATE); computing it as a
    # column first keeps the join an equi-join
    dd = dim_date.select("date_id", F.col("full_date").alias("_q_day"))
    dl = dim_location.select("location_id", "iso_code")
    return (
        staging.withColumn("_q_day", F.to_date(F.col("event_date")))
        .join(dd, "_q_day")
        .join(dl, "iso_code")
    )


def build_facts(
    staging: DataFrame,
    dim_date: DataFrame,
    dim_location: DataFrame,
    disease_id: int = 1,
    source_id: int = 1,
    loaded_at: dt.datetime | None = None,
    matched: Observation | None = None,
) -> DataFrame:
    """Fact rows of a staged batch, without ids.

    A staging row becomes a fact when its day and its location code are known
    to the dimensions and it reports at least one case or death; rows of an
    unknown day or location drop out (J5: list them with
    ``unmatched_staging``, count them through ``matched``).  Disease and
    source are the constants given.  ``recovered`` takes its default 0 and
    ``loaded_at`` the staging value unless a run timestamp is given (L9).
    Counts are cast to INT as the fact columns are; an oversize value raises
    under ANSI rather than wrapping."""
    keyed = _keyed(staging, dim_date, dim_location)
    if matched is not None:
        # rows that found both dimensions, counted by whatever action runs
        # the load (dimension keys are unique, so staging rows minus this
        # count is the number of rows the joins dropped)
        keyed = keyed.observe(matched, F.count(F.lit(1)).alias("rows"))
    keyed = keyed.where((F.col("cases") > 0) | (F.col("deaths") > 0))
    stamp = ts_literal(loaded_at) if loaded_at else F.col("loaded_at")
    return keyed.select(
        F.col("date_id").cast("bigint"),
        F.col("location_id").cast("bigint"),
        F.lit(disease_id).cast("bigint").alias("disease_id"),
        F.lit(source_id).cast("bigint").alias("source_id"),
        F.col("cases").cast("int").alias("cases"),
        F.col("deaths").cast("int").alias("deaths"),
        F.lit(0).cast("int").alias("recovered"),
        stamp.alias("loaded_at"),
    )


def unmatched_staging(
    staging: DataFrame, dim_date: DataFrame, dim_location: DataFrame
) -> DataFrame:
    """Staging rows the fact joins would silently drop (no date or no
    location), every one of them, equal rows included."""
    days = dim_date.select(F.col("full_date").alias("_q_day")).distinct().withColumn("_q_has_day", F.lit(True))
    codes = dim_location.select("iso_code").distinct().withColumn("_q_has_code", F.lit(True))
    joined = (
        staging.withColumn("_q_day", F.to_date(F.col("event_date")))
        .join(days, "_q_day", "left")
        .join(codes, "iso_code", "left")
    )
    lost = joined.where(F.col("_q_has_day").isNull() | F.col("_q_has_code").isNull())
    return lost.select(*staging.columns)


def load_facts(
    facts: DataFrame,
    existing: DataFrame | None = None,
    on_conflict: str = "append",
    natural_key: Sequence[str] = FACT_NATURAL_KEY,
    id_col: str = "event_id",
    start_after: int | None = None,
) -> DataFrame:
    """Rows to append to the fact table, with ids above ``start_after``, the
    high-water mark of the ids (found by a scan of ``existing`` if not given).

    ``on_conflict="append"`` is what the reference does: the fact has no
    unique key, so a rerun duplicates every fact.  ``"ignore"`` is what it
    intends: one row per natural key within the batch and none whose key is
    already loaded (left anti join); the batch is written once, since its
    date range and its rows are both needed.

    Ids come from row positions, so write the result in the action that
    computes it."""
    if on_conflict not in ("append", "ignore"):
        raise ValueError(f"on_conflict must be 'append' or 'ignore', not {on_conflict!r}")
    out = facts
    if on_conflict == "ignore":
        out = first_per_key(out, natural_key)
        if existing is not None:
            out = materialize(out, "batch")
            out = out.join(_conflict_candidates(existing, out, natural_key), list(natural_key), "left_anti")
    mark = max_id(existing, id_col) if start_after is None else start_after
    with_ids = assign_fact_ids(out.select(*FACT_COLUMNS), id_col, mark)
    # rows of a file sorted by (date, location): Parquet row groups then carry
    # tight min/max ranges, so date predicates skip most of the table
    return with_ids.select(id_col, *FACT_COLUMNS).sortWithinPartitions("date_id", "location_id")


def _conflict_candidates(existing: DataFrame, batch: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    """Existing natural keys that could collide with the (written) batch: only
    those in its date_id range.  The range predicate reaches the Parquet scan
    (row groups outside it are skipped), so an incremental load reads and
    shuffles the facts of its own days, not the whole history."""
    keys = existing.select(*natural_key)
    if "date_id" in natural_key:
        lo, hi = batch.agg(F.min("date_id"), F.max("date_id")).first()
        if lo is None:
            return keys.limit(0)
        keys = keys.where(F.col("date_id").between(F.lit(lo), F.lit(hi)))
    # appended history can repeat a key many times; de-duplicate map-side so
    # a hot key on the anti join's lookup side does not land in one task
    return keys.distinct()


def orphan_keys(fact: DataFrame, dim: DataFrame, fk: str, pk: str | None = None) -> DataFrame:
    """Non-NULL foreign keys with no dimension row (must be empty)."""
    pk = pk or fk
    return (
        fact.where(F.col(fk).isNotNull())
        .select(F.col(fk).alias("_q_fk"))
        .join(dim.select(F.col(pk).alias("_q_fk")).distinct(), "_q_fk", "left_anti")
    )
