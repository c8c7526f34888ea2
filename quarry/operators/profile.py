"""Run metrics (A4-A8, A11, G3): one aggregate job computes every requested
measure of a frame; per-stage row counts come from ``DataFrame.observe`` (see
``quarry.operators.clean``) and cost no extra job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def profile(
    df: DataFrame,
    distinct: Sequence[str] = (),
    min_max: Sequence[str] = (),
    conditions: Mapping[str, Column] | None = None,
    null_rates: Sequence[str] = (),
) -> DataFrame:
    """One row: ``row_count`` (A4), ``distinct_<c>`` exact distinct counts
    (A5), ``min_<c>``/``max_<c>`` (A6), one conditional count per named
    predicate (A7) and ``null_rate_<c>`` (A8; NaN counts as NULL in float
    columns; NULL for an empty frame)."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("row_count")]
    aggs += [F.count_distinct(F.col(c)).alias(f"distinct_{c}") for c in distinct]
    for c in min_max:
        aggs += [F.min(F.col(c)).alias(f"min_{c}"), F.max(F.col(c)).alias(f"max_{c}")]
    aggs += [F.count_if(pred).alias(name) for name, pred in (conditions or {}).items()]
    for c in null_rates:
        col = F.col(c)
        is_null = col.isNull() | F.isnan(col) if isinstance(
            df.schema[c].dataType, (T.FloatType, T.DoubleType)
        ) else col.isNull()
        aggs.append((F.count_if(is_null) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias(f"null_rate_{c}"))
    return df.agg(*aggs)


def observed_counts(observations: Mapping[str, Observation]) -> dict[str, int]:
    """Row counts recorded by ``observe`` points, once an action has run."""
    return {stage: int(obs.get.get("rows", 0)) for stage, obs in observations.items()}
