"""The incremental ingest loads each new file once, through the same gate."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from quarry.plans.warehouse import Warehouse
from quarry.sources.inline import reference_tables
from quarry.streaming.ingest import start_ingest

HEADER = ["iso_code", "continent", "location", "date", "new_cases", "new_deaths"]


def _write(folder, name, rows):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(",".join(HEADER) + "\n" + "\n".join(rows) + "\n")


def test_incremental_ingest(spark, scratch_dir):
    src = os.path.join(scratch_dir, "in")
    os.makedirs(src)
    ckpt = os.path.join(scratch_dir, "stream-ckpt")
    wh = Warehouse(spark, f"wh_{uuid.uuid4().hex[:8]}")
    wh.create()
    wh.seed(reference_tables(spark))
    clock = lambda: dt.datetime(2025, 6, 1)
    _write(src, "a.csv", ["IND,Asia,India,2024-01-15,100,2", "USA,,United States,2024-01-15,5,0"])
    q = start_ingest(spark, src, HEADER, wh, ckpt, clock=clock)
    q.awaitTermination(120)
    assert wh.count("fact_health_events") == 2
    _write(src, "b.csv", ["IND,Asia,India,2024-01-16,7,1", "OWID_WRL,,World,2024-01-16,9,9"])
    q = start_ingest(spark, src, HEADER, wh, ckpt, clock=clock)
    q.awaitTermination(120)
    assert wh.count("fact_health_events") == 3
    assert wh.count("dim_location") == 2 and wh.count("dim_date") == 2
    # staging holds the last micro-batch only (replace-load per batch)
    assert wh.count("staging_health_events") == 1


def test_failed_gate_stops_the_stream_and_publishes_nothing(spark, scratch_dir):
    src = os.path.join(scratch_dir, "in")
    os.makedirs(src)
    ckpt = os.path.join(scratch_dir, "stream-ckpt")
    wh = Warehouse(spark, f"wh_{uuid.uuid4().hex[:8]}")
    wh.create()
    wh.seed(reference_tables(spark))
    clock = lambda: dt.datetime(2025, 6, 1)
    _write(src, "a.csv", ["IND,Asia,India,2024-01-15,100,2"])
    start_ingest(spark, src, HEADER, wh, ckpt, clock=clock).awaitTermination(120)
    staged = wh.current_version("staging_health_events")
    _write(src, "b.csv", ["USA,,United States,2030-01-01,5,0"])
    q = start_ingest(spark, src, HEADER, wh, ckpt, clock=clock)
    try:
        q.awaitTermination(120)
        failed = q.exception() is not None
    except Exception:
        failed = True
    assert failed
    assert wh.current_version("staging_health_events") == staged
    assert wh.count("fact_health_events") == 1
