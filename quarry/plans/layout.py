"""Physical layout for repeated big-to-big joins.

``lineitem`` and ``orders`` are joined on the order key by every star query;
without a layout each query shuffles both sides.  Written once as tables
bucketed (and sorted) on the join key with the same bucket count, they join
bucket by bucket: the plan has no exchange and no sort on either side.  The
bucket count should give buckets of a few hundred MB at the target size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_bucketed(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    buckets: int,
    sort: bool = True,
    mode: str = "errorifexists",
) -> DataFrame:
    """Save ``df`` as a Parquet catalog table bucketed by ``keys`` into
    ``buckets`` buckets (sorted by the keys inside each bucket when ``sort``)
    and return the table.  Tables bucketed the same way on their join keys
    join without a shuffle."""
    writer = df.write.format("parquet").mode(mode).bucketBy(buckets, *keys)
    if sort:
        writer = writer.sortBy(*keys)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
