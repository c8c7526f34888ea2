"""Incremental form of the extract -> clean -> gate -> load step.

The reference is batch-only (a full run replaces staging).  The same load
runs here per micro-batch of a file stream: new CSV files in a folder are
read with a fixed all-string schema, cleaned by the same lazy chain, and
each micro-batch goes through ``load_clean`` in ``foreachBatch`` (gate, then
replace staging, insert new dimension rows, load facts).  With
``on_conflict="ignore"`` a micro-batch replayed after a failure loads
nothing twice, so the sink is effectively exactly-once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarry.functions.text import NA_TOKENS, decode_na
from quarry.operators.clean import clean_events
from quarry.plans.elt import load_clean
from quarry.plans.warehouse import Warehouse
from quarry.schemas import RAW_COLUMNS
from quarry.sources.csv import csv_options


def read_csv_stream(
    spark: SparkSession,
    folder: str,
    header_columns: Sequence[str],
    columns: Sequence[str] = RAW_COLUMNS,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """File-stream CSV source.  A stream needs its schema up front, so the
    file's full header (all strings) is given; only ``columns`` are kept.  A
    file whose header differs from it stops the query."""
    missing = [c for c in columns if c not in header_columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header_columns])
    reader = csv_options(spark.readStream.schema(schema))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(folder)
    return raw.select(*[decode_na(F.col(c), NA_TOKENS).alias(c) for c in columns])


def start_ingest(
    spark: SparkSession,
    folder: str,
    header_columns: Sequence[str],
    warehouse: Warehouse,
    checkpoint_location: str,
    on_conflict: str = "ignore",
    available_now: bool = True,
    clock=lambda: dt.datetime.now().replace(microsecond=0),
) -> StreamingQuery:
    """Start the incremental load.  ``available_now=True`` processes every
    file present and stops (a scheduled incremental run); otherwise it keeps
    running.  ``checkpoint_location`` must be on shared storage."""
    warehouse.create()
    raw = read_csv_stream(spark, folder, header_columns)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        run_ts = clock()
        clean = clean_events(batch, run_ts)
        if clean.isEmpty():
            return
        load_clean(clean, warehouse, run_ts, on_conflict=on_conflict)

    writer = raw.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
