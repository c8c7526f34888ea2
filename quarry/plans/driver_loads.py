"""Registered queries of loads: the whole ELT run, what a refused or lost load
leaves behind, dimension loads by bucket, and results kept across loads.

Each query that needs a warehouse makes a database of its own under the
session's warehouse folder, as its result is read after it returns."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from quarry import schemas as SC
from quarry.operators import analytics as A
from quarry.operators import distinct as D
from quarry.operators import facts as F_
from quarry.operators import quality as Q
from quarry.operators import sessions as S
from quarry.plans import driver as base
from quarry.plans.driver import FIRST_LOAD_BEFORE, FIRST_LOAD_BEFORE_SQL, RUN_TS, register
from quarry.plans.elt import EltResult, run_elt
from quarry.plans.warehouse import ConstraintError, Warehouse
from quarry.session import ensure_checkpoint_dir, materialize
from quarry.sources import tables as T
from quarry.sources.csv_records import read_csv_records
from quarry.sources.inline import reference_tables

_RAW_CTE = base._RAW_CTE


def _scratch_warehouse(spark: SparkSession, **options) -> Warehouse:
    return Warehouse(spark, f"quarry_{uuid.uuid4().hex}", **options)


def _csv_of(spark: SparkSession, reports: DataFrame) -> str:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-csv-{uuid.uuid4().hex}"
    reports.select(F.lit("unused").alias("extra"), "*").write.option("header", True).csv(path)
    return path


def _elt(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, EltResult, str]:
    """The whole run over a CSV extract written from the tables."""
    wh = _scratch_warehouse(spark)
    wh.create()
    wh.seed(reference_tables(spark))
    path = _csv_of(spark, T.country_day_reports(spark, sf_dir))
    return wh, run_elt(spark, path, wh, run_ts=RUN_TS), path


@register(
    "elt_star",
    f"""
WITH {_RAW_CTE}
SELECT dd.full_date, dd.week, dd.day_of_week, dl.iso_code, dl.country, 'COVID-19' AS disease_name, 'WHO' AS source_name,
       f.cases, f.deaths, f.recovered, f.loaded_at
FROM facts f JOIN dd ON f.date_id = dd.date_id JOIN dl ON f.location_id = dl.location_id
""",
)
def elt_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 (S1-S4, C1, G1-G3, L1-L6, L10-L12): CSV extract to loaded star, the
    facts joined to the names their keys stand for."""
    wh, _, _ = _elt(spark, sf_dir)
    star = wh.table("fact_health_events").join(wh.table("dim_date"), "date_id").join(wh.table("dim_location"), "location_id")
    star = star.join(wh.table("dim_disease"), "disease_id").join(wh.table("dim_source"), "source_id")
    return star.select("full_date", "week", "day_of_week", "iso_code", "country", "disease_name", "source_name", "cases", "deaths", "recovered", "loaded_at")


_COUNTS = ("staging_health_events", "dim_location", "dim_date", "fact_health_events")
_STATE_SQL = {"staging_health_events": "staging", "dim_location": "dl", "dim_date": "dd", "fact_health_events": "facts"}


def _state_rows(step: str, wh: Warehouse) -> list[tuple]:
    """Rows of each table, counted in its files, and those its state tells."""
    return [(step, name, wh.count(name), wh.stat(name, "rows")) for name in _COUNTS]


def _state_sql(step: str, factor: int = 1) -> str:
    rows = []
    for name, cte in _STATE_SQL.items():
        n = f"CAST({factor if name == 'fact_health_events' else 1} * count(*) AS BIGINT)"
        told = "CAST(NULL AS BIGINT)" if name == "staging_health_events" else n
        rows.append(f"SELECT '{step}' AS step, '{name}' AS table_name, {n} AS found_rows, {told} AS told_rows FROM {cte}")
    return "\nUNION ALL\n".join(rows)


@register(
    "elt_refusals",
    f"WITH {_RAW_CTE}\n"
    + "\nUNION ALL\n".join(
        _state_sql(step, n) for step, n in (("first run", 1), ("gate failed", 1), ("unknown disease", 1), ("lost driver", 1), ("rerun", 2), ("rerun, conflicts ignored", 2))
    ),
)
def elt_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of every table after a run, after a batch
    that the gate refuses, after one whose facts refer to an unknown disease,
    after a load that was written and never committed, and after reruns."""
    wh, _, path = _elt(spark, sf_dir)
    rows = _state_rows("first run", wh)
    future = F.date_format(F.lit(RUN_TS + dt.timedelta(days=2)), "yyyy-MM-dd")
    late = T.country_day_reports(spark, sf_dir).withColumn("date", future)
    for step, csv, options, error in (
        ("gate failed", _csv_of(spark, late), {}, Q.QualityGateError),
        ("unknown disease", path, {"disease_id": 99}, ConstraintError),
    ):
        try:
            run_elt(spark, csv, wh, run_ts=RUN_TS, **options)
        except error:
            rows += _state_rows(step, wh)
    lost = wh.begin()
    lost.append("fact_health_events", F_.load_facts(lost.table("fact_health_events").drop("event_id"), None, "append", start_after=lost.mark("fact_health_events", "event_id")), "event_id")
    rows += _state_rows("lost driver", wh)
    run_elt(spark, path, wh, run_ts=RUN_TS)
    rows += _state_rows("rerun", wh)
    run_elt(spark, path, wh, run_ts=RUN_TS, on_conflict="ignore")
    rows += _state_rows("rerun, conflicts ignored", wh)
    return spark.createDataFrame(rows, "step string, table_name string, found_rows bigint, told_rows bigint")


@register(
    "elt_profile",
    f"""
WITH {_RAW_CTE}
SELECT (SELECT count(*) FROM raw) AS rows_extracted, count(*) AS rows_staged, count(DISTINCT iso_code) AS countries,
       CAST(min(event_date) AS DATE) AS min_date, CAST(max(event_date) AS DATE) AS max_date,
       (SELECT count(*) FROM dl) AS new_locations, (SELECT count(*) FROM dd) AS new_dates,
       (SELECT count(*) FROM facts) AS facts_appended, CAST(0 AS BIGINT) AS staging_unmatched
FROM staging
""",
)
def elt_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run tells about itself."""
    _, res, _ = _elt(spark, sf_dir)
    row = (res.stage_rows["extract"], res.rows_staged, res.countries, res.min_date, res.max_date, res.new_locations, res.new_dates, res.facts_appended, res.staging_unmatched)
    names = "rows_extracted bigint, rows_staged bigint, countries bigint, min_date date, max_date date, new_locations bigint, new_dates bigint, facts_appended bigint, staging_unmatched bigint"
    return spark.createDataFrame([row], names)


@register(
    "fact_ids_lost_load",
    f"""
WITH {_RAW_CTE},
n AS (SELECT count(*) AS b, count_if(full_date < {FIRST_LOAD_BEFORE_SQL}) AS a FROM facts)
SELECT 'first' AS load, a AS fact_rows, a AS distinct_ids, CAST(0 AS BIGINT) AS not_above_earlier FROM n
UNION ALL SELECT 'second', b, b, CAST(0 AS BIGINT) FROM n
UNION ALL SELECT 'after a lost one', b, b, CAST(0 AS BIGINT) FROM n
UNION ALL SELECT 'all', a + 2 * b, a + 2 * b, CAST(0 AS BIGINT) FROM n
""",
)
def fact_ids_lost_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of three loads, with a load in between that wrote its
    facts and was lost before its commit."""
    staging = base._staged(spark, sf_dir)
    dd, dl = materialize(base._dim_date(staging), "dim"), materialize(base._dim_location(staging), "dim")
    early = staging.where(F.col("event_date") < F.lit(FIRST_LOAD_BEFORE))
    wh = _scratch_warehouse(spark)
    wh.create({"fact_health_events": SC.FACT_HEALTH_EVENTS})
    out = None
    for name, rows in (("first", early), ("second", staging), ("lost", staging), ("after a lost one", staging)):
        load = wh.begin()
        mark = load.mark("fact_health_events", "event_id")
        load.append("fact_health_events", F_.load_facts(F_.build_facts(rows, dd, dl), None, "append", start_after=mark), "event_id")
        if name == "lost":
            continue
        load.commit()
        told = _told(load.rows("fact_health_events"), name, mark)
        out = told if out is None else out.unionByName(told)
    return out.unionByName(_told(wh.table("fact_health_events"), "all", 0))


def _told(rows: DataFrame, load: str, above: int) -> DataFrame:
    return rows.agg(
        F.lit(load).alias("load"),
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_distinct("event_id").alias("distinct_ids"),
        F.count_if(F.col("event_id") <= above).alias("not_above_earlier"),
    )


_CUSTOMER_DIM = T_.StructType().add("customer_id", "long").add("c_custkey", "long").add("c_name", "string").add("nation", "string").add("region", "string")
_DIM_BUCKETS = {"dim_customer": (["c_custkey"], 16)}


def _customer_warehouse(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, DataFrame]:
    """The customer dimension after its first load, and the second batch."""
    existing, incoming = base._customer_dims(spark, sf_dir)
    wh = _scratch_warehouse(spark, buckets=_DIM_BUCKETS)
    wh.create({"dim_customer": _CUSTOMER_DIM})
    with wh.begin() as load:
        load.insert_new("dim_customer", existing.drop("customer_id"), ["c_custkey"], "customer_id")
    return wh, incoming


@register("dim_insert_by_bucket", f"WITH {base._CUSTOMER_DIM_CTE}\nSELECT * FROM existing UNION ALL SELECT * FROM added")
def dim_insert_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2/L3 + J6 in the warehouse: a second load appends the customers that
    are new; known rows are neither rewritten nor shuffled."""
    wh, incoming = _customer_warehouse(spark, sf_dir)
    with wh.begin() as load:
        load.insert_new("dim_customer", incoming, ["c_custkey"], "customer_id")
    return wh.table("dim_customer")


@register("dim_upsert_by_bucket", base.oracle_sql()["dim_upsert"])
def dim_upsert_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L7 in the warehouse, in two batches by customer key: each rewrites only
    the buckets its keys fall into."""
    wh, incoming = _customer_warehouse(spark, sf_dir)
    batch = materialize(incoming, "incoming")
    known = batch.join(wh.table("dim_customer").select("c_custkey"), "c_custkey", "left_semi")
    for rows in (known, batch.join(known.select("c_custkey"), "c_custkey", "left_anti")):
        with wh.begin() as load:
            load.upsert("dim_customer", rows, ["c_custkey"], ["nation", "region"], "customer_id")
    return wh.table("dim_customer")


# Results kept across loads ---------------------------------------------------



def _event_loads(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    events = T.read_table(spark, sf_dir, "events").select("user_id", F.col("ts").alias("event_time"), "event_type", "event_id")
    lo, hi = events.agg(F.min("event_time"), F.max("event_time")).first()
    middle = F.lit((lo or RUN_TS) + ((hi or RUN_TS) - (lo or RUN_TS)) / 2).cast("timestamp_ntz")
    first = F.coalesce(F.col("event_time") < middle, F.lit(False))
    return [events.where(first), events.where(~first)]


@register("sessionize_two_loads", base.oracle_sql()["sessionize"].rsplit("ORDER BY user_id, event_time", 1)[0])
def sessionize_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 in two loads: the second windows its own events only and continues
    from the state the first one left; together they equal one run."""
    state, parts = None, []
    for rows in _event_loads(spark, sf_dir):
        done = S.sessionize_load(rows, state, ["user_id"], "event_time", base.SESSION_GAP_MINUTES, ["event_id"])
        parts.append(materialize(done, "sessions"))
        state = materialize(S.session_state(parts[-1], state, ["user_id"], "event_time"), "session-state")
    return parts[0].unionByName(parts[1]).select("user_id", "event_time", "event_type", "gap_minutes", "session_id")


@register(
    "distinct_users_merged",
    """
SELECT CAST(ts AS DATE) AS event_date, event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2
UNION ALL SELECT CAST(ts AS DATE), NULL, count(DISTINCT user_id) FROM events GROUP BY 1
UNION ALL SELECT NULL, event_type, count(DISTINCT user_id) FROM events GROUP BY event_type
UNION ALL SELECT NULL, NULL, count(DISTINCT user_id) FROM events
""",
)
def distinct_users_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct users per day and type, per day, per type and in
    all, from the bitmaps that two loads left."""
    keys = ["event_date", "event_type"]
    states = []
    for rows in _event_loads(spark, sf_dir):
        dated = rows.withColumn("event_date", F.to_date("event_time"))
        states.append(materialize(D.distinct_state(dated, keys, "user_id"), "distinct"))
    state = D.merge_states(states, keys)
    out = None
    for by in (keys, ["event_date"], ["event_type"], []):
        counts = D.distinct_counts(state, by, "users")
        rows = counts.select(*[F.col(k) if k in by else F.lit(None).cast("date" if k == "event_date" else "string").alias(k) for k in keys], "users")
        out = rows if out is None else out.unionByName(rows)
    return out


def _history_specs(df: DataFrame) -> list[Q.CheckSpec]:
    return [
        Q.not_empty(df, min_rows=100),
        Q.required_columns(df, ["l_orderkey", "l_quantity", "l_shipdate"]),
        Q.null_rate(df, "open_units", max_null_rate=0.3),
        Q.no_negatives(df, "net_units"),
        Q.no_negatives(df, "l_quantity"),
        Q.date_range(df, "l_shipdate", dt.datetime(1997, 6, 1)),
    ]


@register(
    "checks_two_batches",
    """
WITH a AS (
    SELECT count(*) AS n, count_if(l_linestatus <> 'O') AS nulls, count_if(l_returnflag = 'R' AND l_quantity > 0) AS negative,
           count_if(l_quantity < 0) AS bad, count_if(l_shipdate > TIMESTAMP '1997-06-02 00:00:00') AS future
    FROM lineitem
)
SELECT 'not_empty' AS check_name, n >= 100 AS passed, CAST(n AS DOUBLE) AS metric, CAST(100 AS DOUBLE) AS threshold,
       'DataFrame has ' || format('{:,}', n) || ' rows (minimum: 100)' AS message FROM a
UNION ALL SELECT 'required_columns', true, 0, 0, 'All required columns present' FROM a
UNION ALL SELECT 'null_rate_open_units', nulls / n <= 0.3, nulls / n, 0.3,
       'Null rate: ' || format('{:.1f}', 100.0 * nulls / n) || '% (max allowed: 30.0%)' FROM a
UNION ALL SELECT 'no_negatives_net_units', negative = 0, negative, 0,
       CASE WHEN negative = 0 THEN 'No negatives found' ELSE format('{:,}', negative) || ' negative values found' END FROM a
UNION ALL SELECT 'no_negatives_l_quantity', bad = 0, bad, 0,
       CASE WHEN bad = 0 THEN 'No negatives found' ELSE format('{:,}', bad) || ' negative values found' END FROM a
UNION ALL SELECT 'date_range', future = 0, future, 1, CASE WHEN future = 0
       THEN 'Dates OK. Range: ' || (SELECT CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR) || ' to ' || CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) FROM lineitem)
       ELSE format('{:,}', future) || ' future dates found' END FROM a
""",
)
def checks_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1-V4, V6, G3, F-F1: checks over a history of two batches from the row
    of aggregates kept with each, messages included; no batch is read twice."""
    li = T.read_table(spark, sf_dir, "lineitem")
    rows = li.select(
        "l_orderkey", "l_quantity", "l_shipdate",
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).alias("open_units"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("net_units"),
    )
    early = F.coalesce(F.col("l_shipdate") < F.lit(dt.datetime(1995, 1, 1)), F.lit(False))
    states = [materialize(Q.check_state(batch, _history_specs(batch)), "checks") for batch in (rows.where(early), rows.where(~early))]
    return Q.results_of_state(Q.merge_check_states(states), _history_specs(rows)).drop("details")


@register(
    "suite_messages",
    f"""
WITH {_RAW_CTE},{base._SUITE_AGG}
SELECT 'not_empty' AS check_name, 'DataFrame has ' || format('{{:,}}', n) || ' rows (minimum: 100)' AS message FROM ad
UNION ALL SELECT 'required_columns', 'All required columns present' FROM ad
UNION ALL SELECT 'null_rate_iso_code', 'Null rate: ' || format('{{:.1f}}', 100.0 * iso_nulls / n) || '% (max allowed: 0.0%)' FROM ad
UNION ALL SELECT 'null_rate_event_date', 'Null rate: ' || format('{{:.1f}}', 100.0 * date_nulls / n) || '% (max allowed: 0.0%)' FROM ad
UNION ALL SELECT 'null_rate_cases', 'Null rate: ' || format('{{:.1f}}', 100.0 * case_nulls / n) || '% (max allowed: 10.0%)' FROM ad
UNION ALL SELECT 'no_negatives_cases', CASE WHEN neg_cases = 0 THEN 'No negatives found' ELSE format('{{:,}}', neg_cases) || ' negative values found' END FROM ad
UNION ALL SELECT 'no_negatives_deaths', CASE WHEN neg_deaths = 0 THEN 'No negatives found' ELSE format('{{:,}}', neg_deaths) || ' negative values found' END FROM ad
UNION ALL SELECT 'date_range', CASE WHEN future = 0 THEN 'Dates OK. Range: ' || (SELECT CAST(CAST(min(event_date) AS DATE) AS VARCHAR) FROM staging)
    || ' to ' || CAST(CAST(max_date AS DATE) AS VARCHAR) ELSE format('{{:,}}', future) || ' future dates found' END FROM ad
UNION ALL SELECT 'iso_code_format', CASE WHEN bad_codes = 0 THEN 'All ISO codes valid' ELSE format('{{:,}}', bad_codes) || ' invalid ISO codes found' END FROM ad
UNION ALL SELECT 'unique_combinations', CASE WHEN dups / rows <= 0.01 THEN 'Uniqueness OK: ' || format('{{:,}}', CAST(dups AS BIGINT)) || ' duplicates ('
    || format('{{:.1f}}', 100.0 * dups / rows) || '%)' ELSE format('{{:,}}', CAST(dups AS BIGINT)) || ' duplicate rows (' || format('{{:.1f}}', 100.0 * dups / rows) || '%)' END FROM ad
UNION ALL SELECT 'country_coverage', codes || ' countries found (minimum: 50)' FROM ad
""",
)
def suite_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-F1, V7: the messages of the 11 checks over staging."""
    staging = base._staged(spark, sf_dir)
    return Q.run_checks(staging, Q.health_suite(staging, RUN_TS)).select("check_name", "message")


@register(
    "footer_counts",
    """
SELECT count(*) AS row_count, min(l_orderkey) AS min_l_orderkey, max(l_orderkey) AS max_l_orderkey, min(l_partkey) AS min_l_partkey,
       max(l_partkey) AS max_l_partkey, min(l_linenumber) AS min_l_linenumber, max(l_linenumber) AS max_l_linenumber FROM lineitem
""",
)
def footer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, A6, L12 from the Parquet footers, without reading a row."""
    return T.footer_aggregates(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_linenumber"])


TOP_ROWS = 2000


@register(
    "top_rows_per_flag",
    f"""
SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(price_rank AS INTEGER) AS price_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY l_returnflag
        ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS price_rank FROM lineitem
) WHERE price_rank <= {TOP_ROWS}
""",
)
def top_rows_per_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4, F10 beyond the group limit: the 2,000 dearest line items of
    each return flag, selected in parts first."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = T.read_table(spark, sf_dir, "lineitem").select("l_returnflag", *keys, "l_extendedprice")
    return A.top_n_per_group(rows, ["l_returnflag"], [F.col("l_extendedprice").desc_nulls_last(), *keys], TOP_ROWS, "price_rank")


@register("csv_texts_with_breaks", "SELECT doc_id, NULLIF(source, '') AS source, NULLIF(text, '') AS text FROM documents")
def csv_texts_with_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, line breaks and quotes in them, written as CSV and read
    back by byte ranges."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-csv-{uuid.uuid4().hex}"
    docs = T.read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    writer = docs.write.option("header", True).option("quoteAll", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    rows = read_csv_records(spark, path, ["doc_id", "source", "text"], ("",))
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text")
