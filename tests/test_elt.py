"""CSV extract + clean chain + warehouse load (C1, C2, S1-S4, L1-L12),
on a synthetic country-day CSV written to a scratch folder."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import quality as Q
from quarry.operators.clean import clean_events
from quarry.plans.elt import run_elt
from quarry.operators.merge import DuplicateKeyError
from quarry.plans import warehouse as W
from quarry.plans.warehouse import ConcurrentLoadError, ConstraintError, Load, Warehouse
from quarry.sources.inline import reference_tables
from quarry.sources.csv import MissingColumnsError, read_csv_projected

RUN_TS = dt.datetime(2025, 6, 1)
HEADER = "iso_code,continent,location,date,total_cases,new_cases,new_deaths,population"
ROWS = [
    "IND,Asia,India,2024-01-15,10,100,2,1",            # valid
    ",Asia,Nowhere,2024-01-15,,5,1,1",                  # empty code -> dropped
    "OWID_WRL,,World,2024-01-15,,1000,10,1",            # aggregate -> dropped
    "ind,Asia,India lower,2024-01-16,,7,0,1",           # kept by clean (fails the strict format check)
    "NaN,Africa,Namibia,2024-01-16,,4,0,1",             # 'NaN' is a missing token -> dropped
    "USA,,United States,2024-01-15,,,,1",               # empty counts -> 0/0: staged, not a fact
    "DEU,,Germany,2024-01-15,,-50,1,1",                 # negative -> dropped
    "DEU,,Germany,2024-01-16,,-0.5,0,1",                # -0.5 -> 0, kept
    "BRA,,Brazil,2024-01-15,,3.9,1,1",                  # 3.9 -> 3
    "ARE,,UAE,2024-01-15,,20,1,1",
    "ARE,,United Arab Emirates,2024-01-16,,30,2,1",     # one code, two names
]


def _warehouse(spark, **options) -> Warehouse:
    wh = Warehouse(spark, f"wh_{uuid.uuid4().hex[:8]}", **options)
    wh.create()
    wh.seed(reference_tables(spark))
    return wh


def _csv(folder: str, rows: list[str], header: str = HEADER) -> str:
    path = os.path.join(folder, f"data-{uuid.uuid4().hex}.csv")
    with open(path, "w") as fh:
        fh.write("\n".join([header, *rows]) + "\n")
    return path


def test_extract_projects_and_decodes(spark, scratch_dir):
    raw = read_csv_projected(spark, _csv(scratch_dir, ROWS))
    assert raw.columns == ["iso_code", "location", "date", "new_cases", "new_deaths"]
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<iso_code:string,location:string,date:string,new_cases:string,new_deaths:string>" in plan
    codes = [r.iso_code for r in raw.collect()]
    assert codes.count(None) == 2


def test_missing_column_is_an_error(spark, scratch_dir):
    path = _csv(scratch_dir, ["IND,India,2024-01-15,1"], header="iso_code,location,date,new_cases")
    with pytest.raises(MissingColumnsError):
        read_csv_projected(spark, path)


def test_clean_chain(spark, scratch_dir):
    obs: dict = {}
    clean = clean_events(read_csv_projected(spark, _csv(scratch_dir, ROWS)), RUN_TS, observations=obs)
    rows = sorted((r.iso_code, r.country, str(r.event_date.date()), r.cases, r.deaths) for r in clean.collect())
    assert rows == [
        ("ARE", "UAE", "2024-01-15", 20, 1),
        ("ARE", "United Arab Emirates", "2024-01-16", 30, 2),
        ("BRA", "Brazil", "2024-01-15", 3, 1),
        ("DEU", "Germany", "2024-01-16", 0, 0),
        ("IND", "India", "2024-01-15", 100, 2),
        ("USA", "United States", "2024-01-15", 0, 0),
        ("ind", "India lower", "2024-01-16", 7, 0),
    ]
    assert set(clean.columns) == {"iso_code", "country", "event_date", "cases", "deaths", "source_name", "loaded_at"}
    counts = {k: v.get["rows"] for k, v in obs.items()}
    assert counts == {"extract": 11, "drop_nulls": 9, "code_length": 8, "non_negative": 7}


@pytest.mark.parametrize("bad_row", ["IND,,India,2024-01-15,,abc,1,1", "IND,,India,2024-13-45,,1,1,1"])
def test_malformed_values_fail_the_run(spark, scratch_dir, bad_row):
    clean = clean_events(read_csv_projected(spark, _csv(scratch_dir, [ROWS[0], bad_row])), RUN_TS)
    with pytest.raises(Exception):
        clean.collect()


def test_elt_end_to_end_and_reruns(spark, scratch_dir):
    wh = _warehouse(spark)
    path = _csv(scratch_dir, ROWS)
    res = run_elt(spark, path, wh, run_ts=RUN_TS)
    assert res.stage_rows == {"extract": 11, "drop_nulls": 9, "code_length": 8, "non_negative": 7}
    assert res.rows_staged == 7 and res.countries == 6
    assert (str(res.min_date), str(res.max_date)) == ("2024-01-15", "2024-01-16")
    assert (res.new_locations, res.new_dates) == (6, 2)
    assert res.facts_appended == 5 and res.fact_rows_total == 5 and res.staging_unmatched == 0

    locs = {r.iso_code: (r.location_id, r.country) for r in wh.table("dim_location").collect()}
    # ids in code order; the first (smallest) name wins for a code with two names
    assert locs == {
        "ARE": (1, "UAE"), "BRA": (2, "Brazil"), "DEU": (3, "Germany"),
        "IND": (4, "India"), "USA": (5, "United States"), "ind": (6, "India lower"),
    }
    dates = sorted((r.date_id, str(r.full_date), r.week, r.day_of_week) for r in wh.table("dim_date").collect())
    assert dates == [(1, "2024-01-15", 3, "Monday"), (2, "2024-01-16", 3, "Tuesday")]
    facts = wh.table("fact_health_events").collect()
    assert sorted((r.location_id, r.cases, r.deaths, r.disease_id, r.source_id, r.recovered) for r in facts) == [
        (1, 20, 1, 1, 1, 0), (1, 30, 2, 1, 1, 0), (2, 3, 1, 1, 1, 0), (4, 100, 2, 1, 1, 0), (6, 7, 0, 1, 1, 0),
    ]
    assert len({r.event_id for r in facts}) == 5
    assert {r.loaded_at for r in facts} == {RUN_TS}

    # rerun as coded: dims unchanged, every fact appended again (no unique key)
    res2 = run_elt(spark, path, wh, run_ts=RUN_TS)
    assert (res2.new_locations, res2.new_dates) == (0, 0)
    assert res2.fact_rows_total == 10
    ids = [r.event_id for r in wh.table("fact_health_events").collect()]
    assert len(set(ids)) == 10

    # rerun as intended: nothing new to insert
    res3 = run_elt(spark, path, wh, run_ts=RUN_TS, on_conflict="ignore")
    assert res3.facts_appended == 0 and res3.fact_rows_total == 10
    # staging keeps only the current and the previous version
    assert len(wh._versions("staging_health_events")) == 2


def test_gate_failure_publishes_nothing(spark, scratch_dir):
    wh = Warehouse(spark, f"wh_{uuid.uuid4().hex[:8]}")
    path = _csv(scratch_dir, [ROWS[0], "USA,,United States,2030-01-01,,5,0,1"])
    with pytest.raises(Q.QualityGateError, match="gate_future_dates"):
        run_elt(spark, path, wh, run_ts=RUN_TS)
    assert wh.count("staging_health_events") == 0
    assert wh.count("fact_health_events") == 0
    # the failed batch was staged unpublished and then dropped
    assert wh._versions("staging_health_events") == [wh.current_version("staging_health_events")]


def test_warehouse_publish_swaps_versions(spark):
    wh = Warehouse(spark, f"wh_{uuid.uuid4().hex[:8]}")
    wh.create()
    v1 = wh.current_version("dim_source")
    df = spark.createDataFrame([(1, "WHO", "https://www.who.int/data", "Daily")], wh.table("dim_source").schema)
    # reading the table while publishing its next version is safe
    wh.publish({"dim_source": wh.table("dim_source").unionByName(df)})
    assert wh.current_version("dim_source") == v1 + 1
    assert wh.count("dim_source") == 1
    assert wh.vacuum("dim_source", keep=1) == [v1]


def test_recency_filter_keeps_last_n_days(spark, scratch_dir):
    rows = ["IND,,India,2025-05-01,,1,0,1", "IND,,India,2025-03-01,,1,0,1"]
    clean = clean_events(read_csv_projected(spark, _csv(scratch_dir, rows)), RUN_TS, since_days=90)
    assert [str(r.event_date.date()) for r in clean.collect()] == ["2025-05-01"]


def test_cli_load_and_validate(spark, scratch_dir, capsys):
    from quarry import cli

    good = _csv(scratch_dir, ROWS)
    db = f"wh_{uuid.uuid4().hex[:8]}"
    assert cli.main(["seed", "--database", db]) == 0
    assert cli.main(["load", good, "--database", db]) == 0
    assert "facts appended 5" in capsys.readouterr().out
    bad = _csv(scratch_dir, [ROWS[0], "USA,,United States,2999-01-01,,5,0,1"])
    assert cli.main(["load", bad, "--database", f"wh_{uuid.uuid4().hex[:8]}"]) == 1
    assert cli.main(["validate", good, "--now", "2025-06-01"]) == 1
    out = capsys.readouterr().out
    assert "[FAIL ✗] country_coverage: 6 countries found (minimum: 50)" in out
    assert "[FAIL ✗] iso_code_format: 1 invalid ISO codes found" in out
    assert "[FAIL ✗] not_empty: DataFrame has 7 rows (minimum: 100)" in out
    assert out.strip().endswith("8 passed, 3 failed")


def test_cli_seed_and_reports(spark, scratch_dir, capsys):
    from quarry import cli

    db = f"wh_{uuid.uuid4().hex[:8]}"
    assert cli.main(["seed", "--database", db]) == 0
    assert cli.main(["report", "rate", "--database", db]) == 0
    assert "Germany" in capsys.readouterr().out
    out = os.path.join(scratch_dir, "report")
    assert cli.main(["report", "sessions", "--database", db, "--output", out]) == 0
    assert spark.read.option("header", True).csv(out).count() == 7
    for name in ["star", "rank", "top", "continent", "sessions"]:
        assert cli.main(["report", name, "--database", db]) == 0


def test_partitioned_fact_table_prunes_by_date(spark, scratch_dir):
    wh = _warehouse(spark, partition_by={"fact_health_events": ["date_id"]})
    res = run_elt(spark, _csv(scratch_dir, ROWS), wh, run_ts=RUN_TS)
    assert res.fact_rows_total == 5
    facts = wh.table("fact_health_events")
    assert facts.columns[-1] == "date_id"
    q = facts.where("date_id = 2")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_id" in plan
    assert q.count() == 2  # 2024-01-16: ARE 30/2 and ind 7/0 (the 0/0 row is not a fact)
    # a join with a filtered date dimension prunes fact directories at run time
    tuesdays = wh.table("dim_date").where("day_of_week = 'Tuesday'")
    dpp = facts.join(tuesdays, "date_id")
    assert "dynamicpruning" in dpp._jdf.queryExecution().executedPlan().toString().lower()
    assert dpp.count() == 2
    # rerun in ignore mode appends nothing to the partitioned table
    assert run_elt(spark, _csv(scratch_dir, ROWS), wh, run_ts=RUN_TS, on_conflict="ignore").facts_appended == 0


def test_a_missing_disease_refuses_the_load(spark, scratch_dir):
    wh = Warehouse(spark, f"wh_{uuid.uuid4().hex[:8]}")
    wh.create()
    wh.seed({"dim_source": reference_tables(spark)["dim_source"]})
    with pytest.raises(ConstraintError, match="fk_disease_id: 5"):
        run_elt(spark, _csv(scratch_dir, ROWS), wh, run_ts=RUN_TS)
    assert wh.count("fact_health_events") == 0


def test_dimensions_become_visible_together(spark, scratch_dir, monkeypatch):
    wh = _warehouse(spark)
    write = Warehouse._write_version

    def failing(self, name, df):
        if name == "dim_date":
            raise RuntimeError("disk full")
        return write(self, name, df)

    monkeypatch.setattr(Warehouse, "_write_version", failing)
    with pytest.raises(RuntimeError, match="disk full"):
        wh.publish({"dim_location": spark.createDataFrame([(1, "India", None, None, "IND")], wh.table("dim_location").schema), "dim_date": wh.table("dim_date")})
    monkeypatch.undo()
    assert wh.count("dim_location") == 0 and wh._versions("dim_location") == [wh.current_version("dim_location")]


def test_lengths_nulls_and_duplicates_are_refused(spark):
    wh = _warehouse(spark)
    schema = "location_id bigint, country string, region string, continent string, iso_code string"
    for row, error in (((1, "India", None, None, "TOOLONG"), "(?i)length"), ((1, None, None, None, "IND"), "not_null_country")):
        with pytest.raises(Exception, match=error):
            wh.publish({"dim_location": spark.createDataFrame([row], schema)})
    twice = [(1, "India", None, None, "IND"), (2, "Bharat", None, None, "IND"), (3, "Nowhere", None, None, None), (4, "Nowhere", None, None, None)]
    with pytest.raises(ConstraintError, match="unique_iso_code: 1"):
        wh.publish({"dim_location": spark.createDataFrame(twice, schema)})
    assert wh.count("dim_location") == 0


def test_versions_of_any_length(spark):
    wh = _warehouse(spark)
    wh._move({"dim_source": wh._write_version("dim_source", wh.table("dim_source"))})
    table = wh._create_physical("dim_source", 1_234_567, wh.table("dim_source").schema)
    assert table.endswith("__v1234567") and wh._versions("dim_source")[-1] == 1_234_567
    wh._move({"dim_source": 1_234_567})
    assert wh.current_version("dim_source") == 1_234_567 and wh.count("dim_source") == 0


def test_a_load_does_not_scan_the_fact_history(spark, scratch_dir):
    wh = _warehouse(spark)
    run_elt(spark, _csv(scratch_dir, ROWS), wh, run_ts=RUN_TS)
    first = wh.stat("fact_health_events", "max_id")
    assert wh.stat("fact_health_events", "rows") == 5 and first == max(r.event_id for r in wh.table("fact_health_events").collect())
    res = run_elt(spark, _csv(scratch_dir, ROWS), wh, run_ts=RUN_TS)
    assert res.fact_rows_total == 10 == wh.stat("fact_health_events", "rows")
    ids = sorted(r.event_id for r in wh.table("fact_health_events").collect())
    assert len(set(ids)) == 10 and sum(i > first for i in ids) == 5


def _with_history(spark, scratch_dir):
    wh = _warehouse(spark)
    run_elt(spark, _csv(scratch_dir, ROWS), wh, run_ts=RUN_TS)
    return wh, {r.event_id for r in wh.table("fact_health_events").collect()}


@pytest.mark.parametrize("lost_in", ["_commit", "_check"])
def test_ids_and_counts_survive_a_lost_driver(spark, scratch_dir, monkeypatch, lost_in):
    """The driver is lost after the facts are written and before the commit,
    without a chance to clean up; the next load must not meet its rows or ids."""
    wh, first = _with_history(spark, scratch_dir)
    locations = wh.count("dim_location")

    def lost(self, *args, **kwargs):
        raise KeyboardInterrupt("driver lost")

    more = [*ROWS, "FRA,,France,2024-02-01,,9,1,1"]
    monkeypatch.setattr(Load, "abort", lambda self: None)
    real = getattr(Warehouse, lost_in)
    reached = lambda self, name, *a: lost(self) if name == "fact_health_events" else real(self, name, *a)
    begun = []
    begin = Warehouse.begin

    def begin_then_fail(self):
        begun.append(begin(self))
        monkeypatch.setattr(Warehouse, lost_in, lost if lost_in == "_commit" else reached)
        return begun[-1]

    monkeypatch.setattr(Warehouse, "begin", begin_then_fail)
    with pytest.raises(KeyboardInterrupt):
        run_elt(spark, _csv(scratch_dir, more), wh, run_ts=RUN_TS)
    monkeypatch.undo()
    # the rows are on disk, but nobody sees them
    assert begun[0].rows("fact_health_events").count() == 6
    assert {r.event_id for r in wh.table("fact_health_events").collect()} == first and wh.count("dim_location") == locations

    again = Warehouse(spark, wh.db)
    res = run_elt(spark, _csv(scratch_dir, more), again, run_ts=RUN_TS)
    rows = again.table("fact_health_events").collect()
    assert len(rows) == len({r.event_id for r in rows}) == res.fact_rows_total == again.stat("fact_health_events", "rows") == 11
    assert sum(r.event_id > max(first) for r in rows) == 6 and res.new_locations == 1
    assert again.check_counts() == {} and spark.table(f"{wh.db}.fact_health_events").count() == 11
    # its files go with the next vacuum
    again.vacuum("fact_health_events")
    assert begun[0].rows("fact_health_events").count() == 0 and again.count("fact_health_events") == 11


def test_dimensions_and_facts_become_visible_together(spark, scratch_dir):
    wh = Warehouse(spark, f"wh_{uuid.uuid4().hex[:8]}")
    wh.create()
    wh.seed({"dim_source": reference_tables(spark)["dim_source"]})
    with pytest.raises(ConstraintError, match="fk_disease_id"):
        run_elt(spark, _csv(scratch_dir, ROWS), wh, run_ts=RUN_TS)
    assert wh.count("dim_location") == wh.count("dim_date") == wh.count("fact_health_events") == 0


def test_of_two_loads_at_once_one_is_refused(spark):
    wh = _warehouse(spark)
    row = spark.createDataFrame([(9, "NASA", None, "Daily")], wh.table("dim_source").schema)
    before = wh.count("dim_source")
    a, b = wh.begin(), wh.begin()
    assert a.number != b.number
    a.append("dim_source", row)
    b.append("dim_source", row)
    b.commit()
    with pytest.raises(ConcurrentLoadError, match="dim_source"):
        a.commit()
    assert wh.count("dim_source") == before + 1 and a.rows("dim_source").count() == 0
    # the later number was committed; the earlier one is never seen
    wh.append("dim_source", spark.createDataFrame([(10, "NOAA", None, "Daily")], wh.table("dim_source").schema))
    assert wh.count("dim_source") == before + 2 and wh._of("dim_source").loads == ((0, 0), (b.number, b.number + 1))


def test_loads_from_threads_lose_no_commit(spark):
    wh = _warehouse(spark)
    wh.create({f"t{k}": T.StructType().add("x", "long") for k in range(4)})
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: wh.append(f"t{k}", spark.range(k + 1).withColumnRenamed("id", "x")), range(4)))
    assert [wh.count(f"t{k}") for k in range(4)] == [1, 2, 3, 4] and wh.check_counts() == {}


def test_a_lock_of_a_lost_driver_is_broken(spark, monkeypatch):
    wh = _warehouse(spark)
    spark.sql(f"CREATE TABLE {wh.db}.{W.LOCK} (x INT) USING parquet TBLPROPERTIES ('quarry.taken' = '1.0')")
    wh.append("dim_source", wh.table("dim_source").limit(0))
    spark.sql(f"CREATE TABLE {wh.db}.{W.LOCK} (x INT) USING parquet TBLPROPERTIES ('quarry.taken' = '9e9')")
    with pytest.raises(ConcurrentLoadError, match="not released"):
        with wh._locked(wait_seconds=0.2):
            pass


DIM = T.StructType().add("customer_id", "long").add("code", "string").add("name", "string").add("region", "string")


def _dim(spark, **options):
    wh = Warehouse(spark, f"wh_{uuid.uuid4().hex[:8]}", **options)
    wh.create({"dim": DIM})
    return wh


@pytest.mark.parametrize("buckets", [None, {"dim": (["code"], 16)}])
def test_dimension_loads_by_bucket(spark, buckets):
    wh = _dim(spark, buckets=buckets)
    rows = spark.range(400).select(F.format_string("c%03d", "id").alias("code"), F.lit("n").alias("name"), F.lit(None).cast("string").alias("region"))
    with wh.begin() as load:
        assert load.insert_new("dim", rows, ["code"], "customer_id") == 400
    with wh.begin() as load:  # two known, one new, one without a key, one twice
        batch = [("c007", "other", "r"), ("c009", "other", "r"), ("new", "n", "r"), (None, "n", "r"), ("new", "n", "r")]
        assert load.insert_new("dim", spark.createDataFrame(batch, "code string, name string, region string"), ["code"], "customer_id") == 1
    with wh.begin() as load:
        files = set(load.table("dim").inputFiles())
        batch = spark.createDataFrame([("c005", "x", "EU"), ("zz", "x", "EU")], "code string, name string, region string")
        written = load.upsert("dim", batch, ["code"], ["region"], "customer_id")
    got = {r.code: (r.customer_id, r.name, r.region) for r in wh.table("dim").collect()}
    assert len(got) == wh.count("dim") == wh.stat("dim", "rows") == 402 and wh.check_counts() == {}
    assert got["c005"] == (6, "n", "EU") and got["c007"] == (8, "n", None) and got["new"] == (401, "n", "r") and got["zz"] == (402, "x", "EU")
    assert spark.table(f"{wh.db}.dim").count() == 402 and wh.stat("dim", "max_id") == 402
    if buckets:  # two of sixteen buckets were rewritten, the other files are still read
        assert written < 120 and len(files & set(wh.table("dim").inputFiles())) >= len(files) - 4
    with pytest.raises(DuplicateKeyError), wh.begin() as load:
        load.upsert("dim", batch.unionByName(batch), ["code"], ["region"], "customer_id")
    assert wh.count("dim") == 402


def test_an_insert_reads_the_keys_buckets_and_shuffles_no_known_row(spark):
    from quarry.operators.merge import new_rows

    wh = _dim(spark, buckets={"dim": (["code"], 16)})
    rows = spark.range(400).select(F.format_string("c%03d", "id").alias("code"), F.lit("n").alias("name"), F.lit(None).cast("string").alias("region"))
    with wh.begin() as load:
        load.insert_new("dim", rows, ["code"], "customer_id")
    load = wh.begin()
    batch = rows.where("code = 'c005'")
    old = load.table("dim", load._touched("dim", batch))
    assert len(old.inputFiles()) < len(load.table("dim").inputFiles())
    known = old.select("code").join(batch.select("code"), ["code"], "left_semi")
    known.collect()
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert new_rows(old, batch, ["code"], "customer_id").count() == 0
