"""Analytic operators over a star schema.  Column names are arguments, so the
same operators run on the health star and on any other fact/dimension set.

Windowed operators that partition by a possibly hot key live in
``quarry.operators.ordered`` (RANK/LAG, sessionisation)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from quarry.functions.numeric import safe_pct
from quarry.operators.ordered import rank_and_lag, sessionize

__all__ = [
    "death_rate",
    "filtered_sum",
    "order_desc",
    "rank_and_lag",
    "ratio_having",
    "sessionize",
    "sum_by",
    "top_n_per_group",
]


def death_rate(df: DataFrame, num: str, den: str, alias: str = "death_rate_pct") -> DataFrame:
    """Add the safe percentage ``ROUND(num / NULLIF(den, 0) * 100, 2)``."""
    return df.withColumn(alias, safe_pct(num, den, fractional=_fractional(df, num, den)))


def _fractional(df: DataFrame, *cols: str) -> bool:
    return not all(isinstance(df.schema[c].dataType, IntegralType) for c in cols)


def order_desc(df: DataFrame, col: str, tie_cols: Sequence[str] = ()) -> DataFrame:
    """``ORDER BY col DESC`` with PostgreSQL NULL placement (NULLs first).
    ``tie_cols`` make the order total; they also let the range partitioner
    split a heavily repeated sort value over many tasks."""
    return df.orderBy(F.col(col).desc_nulls_first(), *[F.col(t).asc_nulls_last() for t in tie_cols])


def sum_by(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """``SELECT keys, SUM(m) AS alias ... GROUP BY keys`` (NULL keys form a
    group).  Integers are summed as BIGINT, decimals and floating point
    numbers as they are."""

    def total(src: str) -> Column:
        return F.sum(F.col(src) if _fractional(df, src) else F.col(src).cast("bigint"))

    return df.groupBy(*keys).agg(*[total(src).alias(alias) for alias, src in measures.items()])


def filtered_sum(
    df: DataFrame,
    predicate: Column,
    keys: Sequence[str],
    measures: Mapping[str, str],
) -> DataFrame:
    """WHERE on a dimension attribute, then SUM by keys.  The predicate is a
    plain Column, so Catalyst pushes it into the dimension's Parquet scan."""
    return sum_by(df.where(predicate), keys, measures)


def ratio_having(
    df: DataFrame,
    keys: Sequence[str],
    num: str,
    den: str,
    min_pct: float = 1.0,
    num_alias: str = "total_deaths",
    den_alias: str = "total_cases",
    rate_alias: str = "death_rate_pct",
) -> DataFrame:
    """SUM two measures per group, rate = safe_pct(sum num, sum den), keep
    groups whose rate is strictly above ``min_pct`` (a NULL rate drops out),
    ordered by rate DESC NULLS FIRST then keys."""
    agg = sum_by(df, keys, {den_alias: den, num_alias: num})
    rated = agg.withColumn(rate_alias, safe_pct(num_alias, den_alias, fractional=_fractional(agg, num_alias, den_alias)))
    return rated.where(F.col(rate_alias) > F.lit(float(min_pct))).orderBy(
        F.col(rate_alias).desc_nulls_first(), *[F.col(k).asc_nulls_last() for k in keys]
    )


def top_n_per_group(
    df: DataFrame,
    partition_cols: Sequence[str],
    order: Sequence[Column],
    n: int = 1,
    rn_alias: str | None = None,
    parts: int = 64,
) -> DataFrame:
    """Top-``n`` rows per group by ``ROW_NUMBER()``.  ``order`` should end in a
    unique key so ties resolve deterministically.  The filter on the row number
    plans as ``WindowGroupLimit``: each task keeps at most ``n`` rows per group
    *before* the shuffle, so a hot group costs no more than a cold one.

    Spark applies that limit for ``n`` up to ``spark.sql.optimizer.
    windowGroupLimitThreshold`` (1,000 by default).  Beyond it a hot group
    would be sorted whole by one task, so there each group is dealt into
    ``parts`` parts by the hash of its rows; every part selects its own top
    ``n``, and of a group at most ``parts * n`` rows meet in the last window.
    Equal rows fall into one part and are interchangeable."""
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit and parts > 1:
        dealt = df.withColumn("_q_part", F.pmod(F.xxhash64(*df.columns), F.lit(parts)))
        own = Window.partitionBy(*partition_cols, "_q_part").orderBy(*order)
        df = dealt.withColumn("_q_rn", F.row_number().over(own)).where(F.col("_q_rn") <= n).drop("_q_rn", "_q_part")
    w = Window.partitionBy(*partition_cols).orderBy(*order)
    ranked = df.withColumn("_q_rn", F.row_number().over(w)).where(F.col("_q_rn") <= n)
    if rn_alias:
        return ranked.withColumnRenamed("_q_rn", rn_alias)
    return ranked.drop("_q_rn")
