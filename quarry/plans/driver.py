"""Driver queries: each operator of the survey run over the driver's tables,
plus the DuckDB SQL that computes the same result independently.

Every query reads whole tables (or data Spark derives from them); none is
limited to a subset of ids or rows.  Integer outputs are BIGINT and ratios
DOUBLE on both sides so schemas and value hashes line up.  Column names are
aliased identically in Spark and SQL."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas as SC
from quarry.operators import analytics as A
from quarry.operators import calendar as Cal
from quarry.operators import clean as C
from quarry.operators import facts as F_
from quarry.operators import keys as K
from quarry.operators import merge as M
from quarry.operators import profile as P
from quarry.operators import quality as Q
from quarry.session import ensure_checkpoint_dir, materialize
from quarry.sources import tables as T
from quarry.sources.csv import read_csv_projected

QueryFn = Callable[[SparkSession, str], DataFrame]

# Rows of a group above which the *_split queries split it: far below what a
# task can sort, so that splitting shows at every size of the tables.
SPLIT_ROWS = 1500
SPLIT_GAP_MINUTES = 10.0

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql.strip()
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


# --------------------------------------------------------------------------
# SQL building blocks (DuckDB dialect).  ``_RATE(d, c)`` is the exact
# ROUND(d / NULLIF(c, 0) * 100, 2) on non-negative integers, as DOUBLE.
# --------------------------------------------------------------------------


def _rate_sql(d: str, c: str) -> str:
    return (
        f"CASE WHEN ({c}) = 0 THEN NULL ELSE "
        f"CAST((20000 * ({d}) + ({c})) // (2 * ({c})) AS DOUBLE) / 100.0 END"
    )


_STAR_CTE = """
f AS (
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(trunc(l_quantity) AS BIGINT) AS cases,
           CASE WHEN l_returnflag = 'R' THEN CAST(trunc(l_quantity) AS BIGINT) ELSE 0 END AS deaths,
           CASE WHEN l_linestatus = 'F' THEN CAST(trunc(l_quantity) AS BIGINT) ELSE 0 END AS recovered
    FROM lineitem
),
loc AS (
    SELECT c.c_custkey AS o_custkey, n.n_name AS country, r.r_name AS continent
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
),
star_np AS (
    SELECT f.*, CAST(o.o_orderdate AS DATE) AS event_date, loc.country, loc.continent
    FROM f
    JOIN orders o ON f.l_orderkey = o.o_orderkey
    JOIN loc ON o.o_custkey = loc.o_custkey
),
star AS (
    SELECT s.*, p.p_name AS disease_name, p.p_type AS disease_type
    FROM star_np s
    JOIN part p ON s.l_partkey = p.p_partkey
)
"""


def _star(spark: SparkSession, sf_dir: str, with_part: bool = True) -> DataFrame:
    """lineitem -> orders -> customer -> nation/region (-> part), the
    snowflake every analytic query starts from.  Big-to-big joins are left to
    the planner (sort-merge, AQE skew splitting); nation/region are
    size-checked broadcasts."""
    star = (
        T.event_facts(spark, sf_dir)
        .join(T.order_dates(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(T.customer_locations(spark, sf_dir), "o_custkey")
    )
    if with_part:
        star = star.join(T.diseases(spark, sf_dir), "l_partkey")
    return star


# C3 -----------------------------------------------------------------------


@register(
    "star_report",
    f"""
WITH {_STAR_CTE}
SELECT event_date, country, continent, disease_name, disease_type,
       cases, deaths, recovered, {_rate_sql('deaths', 'cases')} AS death_rate_pct
FROM star
ORDER BY cases DESC NULLS FIRST, l_orderkey, l_linenumber, l_partkey, deaths, recovered
""",
)
def star_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable star report (J1 + P7 + O1): the fact joined to all its
    dimensions, death rate per row, highest case counts first."""
    report = A.death_rate(_star(spark, sf_dir), "deaths", "cases")
    ordered = A.order_desc(report, "cases", ["l_orderkey", "l_linenumber", "l_partkey", "deaths", "recovered"])
    return ordered.select(
        "event_date",
        "country",
        "continent",
        "disease_name",
        "disease_type",
        "cases",
        "deaths",
        "recovered",
        "death_rate_pct",
    )


# C4 -----------------------------------------------------------------------


@register(
    "rank_lag",
    f"""
WITH {_STAR_CTE}
SELECT country, disease_name, cases,
       CAST(RANK() OVER (PARTITION BY l_partkey ORDER BY cases DESC NULLS FIRST) AS BIGINT)
           AS rank_within_disease,
       LAG(cases) OVER (PARTITION BY l_partkey
                        ORDER BY cases DESC NULLS FIRST, l_orderkey, l_linenumber)
           AS prev_country_cases
FROM star
""",
)
def rank_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RANK and LAG of cases within each disease (C4: J2 + W1 + W2).  Both
    windows share one partitioning; a hot disease is split by case ranges.
    The windows run over the fact with the country of its order; the disease
    only has to exist before them (semi join), and its name is joined after,
    so no join is keyed by a hot disease while rows are still to be ranked."""
    located = _star(spark, sf_dir, with_part=False).select("l_orderkey", "l_linenumber", "l_partkey", "cases", "country")
    names = T.diseases(spark, sf_dir).select("l_partkey", "disease_name")
    ranked = A.rank_and_lag(
        located.join(names.select("l_partkey"), "l_partkey", "left_semi"),
        ["l_partkey"],
        "cases",
        tie_cols=["l_orderkey", "l_linenumber"],
        rank_alias="rank_within_disease",
        lag_alias="prev_country_cases",
        probe=T.event_facts(spark, sf_dir),
    )
    return ranked.join(names, "l_partkey").select(
        "country", "disease_name", "cases", "rank_within_disease", "prev_country_cases"
    )


@register(
    "rank_lag_split",
    """
WITH f AS (
    SELECT l_linestatus, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
           CAST(trunc(l_quantity) AS BIGINT) AS cases
    FROM lineitem
)
SELECT l_linestatus, l_orderkey, l_linenumber, l_partkey, cases,
       CAST(RANK() OVER (PARTITION BY l_linestatus ORDER BY cases DESC NULLS FIRST) AS BIGINT) AS rank_in_status,
       LAG(cases) OVER (PARTITION BY l_linestatus ORDER BY cases DESC NULLS FIRST,
                        l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS prev_cases
FROM f
""",
)
def rank_lag_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + W2 with every group split: each line status holds a large part of
    all rows, so its windows always run over several ranges."""
    rows = T.read_table(spark, sf_dir, "lineitem").select(
        "l_linestatus", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
        F.col("l_quantity").cast("bigint").alias("cases"),
    )
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    out = A.rank_and_lag(rows, ["l_linestatus"], "cases", tie_cols=ties, rank_alias="rank_in_status", lag_alias="prev_cases", max_group_rows=SPLIT_ROWS)
    return out.select("l_linestatus", "l_orderkey", "l_linenumber", "l_partkey", "cases", "rank_in_status", "prev_cases")


# C5 -----------------------------------------------------------------------


@register(
    "top_per_group",
    f"""
WITH {_STAR_CTE},
by_continent AS (
    SELECT continent, disease_name,
           CAST(SUM(cases) AS BIGINT) AS total_cases,
           CAST(SUM(deaths) AS BIGINT) AS total_deaths
    FROM star
    GROUP BY continent, disease_name
),
ranked AS (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY continent
                                 ORDER BY total_cases DESC NULLS FIRST, disease_name) AS row_num
    FROM by_continent
)
SELECT continent, disease_name, total_cases, total_deaths
FROM ranked
WHERE row_num = 1
ORDER BY total_cases DESC NULLS FIRST, continent
""",
)
def top_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top disease per continent (C5: A1 -> W3 -> F10 -> O1): SUM by
    (continent, disease), ROW_NUMBER per continent, keep row 1."""
    by_continent = A.sum_by(
        _star(spark, sf_dir),
        ["continent", "disease_name"],
        {"total_cases": "cases", "total_deaths": "deaths"},
    )
    top = A.top_n_per_group(
        by_continent,
        ["continent"],
        [F.col("total_cases").desc_nulls_first(), F.col("disease_name").asc_nulls_last()],
        n=1,
    )
    return A.order_desc(top, "total_cases", ["continent"]).select(
        "continent", "disease_name", "total_cases", "total_deaths"
    )


def _per_order_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases and deaths summed per order *before* joining the order's
    customer: SUM is decomposable, the map-side partial aggregate shrinks the
    biggest table, and its output is already partitioned by the order key the
    next join needs."""
    return (
        T.event_facts(spark, sf_dir)
        .groupBy("l_orderkey")
        .agg(F.sum("cases").alias("cases"), F.sum("deaths").alias("deaths"))
        .join(T.order_dates(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(T.customer_locations(spark, sf_dir), "o_custkey")
    )


# C6 -----------------------------------------------------------------------


@register(
    "filtered_agg",
    f"""
WITH {_STAR_CTE}
SELECT country, CAST(SUM(cases) AS BIGINT) AS total_cases
FROM star_np
WHERE continent = 'ASIA'
GROUP BY country
""",
)
def filtered_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases by country within one continent (C6: J3 + F8 + A2).  The filter
    on the dimension reaches the region scan as a pushed filter; orders are
    cut to the continent's customers before line items join, so that a
    runtime filter can drop the other line items before their shuffle."""
    places = T.customer_locations(spark, sf_dir)
    located = T.order_dates(spark, sf_dir).join(places, "o_custkey").select(F.col("o_orderkey").alias("l_orderkey"), "country", "continent")
    return A.filtered_sum(
        T.event_facts(spark, sf_dir).join(located, "l_orderkey"),
        F.col("continent") == F.lit("ASIA"),
        ["country"],
        {"total_cases": "cases"},
    )


# C7 -----------------------------------------------------------------------

AGG_HAVING_MIN_PCT = 33.0


@register(
    "agg_having",
    f"""
WITH {_STAR_CTE},
by_country AS (
    SELECT country, CAST(SUM(cases) AS BIGINT) AS total_cases,
           CAST(SUM(deaths) AS BIGINT) AS total_deaths
    FROM star_np
    GROUP BY country
)
SELECT country, total_cases, total_deaths,
       {_rate_sql('total_deaths', 'total_cases')} AS death_rate_pct
FROM by_country
WHERE {_rate_sql('total_deaths', 'total_cases')} > {AGG_HAVING_MIN_PCT}
ORDER BY death_rate_pct DESC NULLS FIRST, country
""",
)
def agg_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries whose death rate is above a threshold (C7: A3 + F9 + O2)."""
    return A.ratio_having(
        _per_order_measures(spark, sf_dir),
        ["country"],
        num="deaths",
        den="cases",
        min_pct=AGG_HAVING_MIN_PCT,
    ).select("country", "total_cases", "total_deaths", "death_rate_pct")


# C8 -----------------------------------------------------------------------

SESSION_GAP_MINUTES = 30


@register(
    "sessionize",
    f"""
WITH g AS (
    SELECT user_id, ts AS event_time, event_type,
           (epoch_us(ts) - epoch_us(LAG(ts) OVER (PARTITION BY user_id
                                                  ORDER BY ts ASC NULLS LAST, event_id)))
               / CAST(60000000 AS DOUBLE) AS gap_minutes
    FROM events
)
SELECT user_id, event_time, event_type, gap_minutes,
       CAST(SUM(CASE WHEN gap_minutes > {SESSION_GAP_MINUTES} OR gap_minutes IS NULL THEN 1 ELSE 0 END)
            OVER (PARTITION BY user_id ORDER BY event_time ASC NULLS LAST) AS BIGINT) AS session_id
FROM g
ORDER BY user_id, event_time
""",
)
def sessionize_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-preserving sessionisation of the event log (C8: W4/W5 -> F-C1 ->
    W6 -> O3): a gap of more than 30 minutes opens a new session."""
    events = T.read_table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").alias("event_time"), "event_type", "event_id"
    )
    sess = A.sessionize(
        events,
        ["user_id"],
        "event_time",
        gap_minutes=SESSION_GAP_MINUTES,
        tie_cols=["event_id"],
    )
    return sess.orderBy(
        F.col("user_id").asc_nulls_last(), F.col("event_time").asc_nulls_last(), "event_id"
    ).select("user_id", "event_time", "event_type", "gap_minutes", "session_id")


@register(
    "sessionize_split",
    f"""
WITH g AS (
    SELECT event_type, ts AS event_time, event_id,
           epoch_us(ts) - epoch_us(LAG(ts) OVER (PARTITION BY event_type ORDER BY ts ASC NULLS LAST, event_id)) AS us
    FROM events
), m AS (SELECT *, us / CAST(60000000 AS DOUBLE) AS gap_minutes FROM g)
SELECT event_type, event_time, event_id, gap_minutes,
       CAST(SUM(CASE WHEN gap_minutes > {SPLIT_GAP_MINUTES} OR gap_minutes IS NULL THEN 1 ELSE 0 END)
            OVER (PARTITION BY event_type ORDER BY event_time ASC NULLS LAST) AS BIGINT) AS session_id
FROM m
""",
)
def sessionize_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4-W6 with every group split: bursts of activity per event type."""
    events = T.read_table(spark, sf_dir, "events").select("event_type", F.col("ts").alias("event_time"), "event_id")
    return A.sessionize(
        events, ["event_type"], "event_time", gap_minutes=SPLIT_GAP_MINUTES, tie_cols=["event_id"], max_group_rows=SPLIT_ROWS
    ).select("event_type", "event_time", "event_id", "gap_minutes", "session_id")


# ==========================================================================
# ELT side: extract -> clean -> gate -> staging -> dimensions -> facts
# ==========================================================================

# Fixed run clock so results are reproducible (the pipeline takes it once).
RUN_TS = dt.datetime(2025, 6, 1)
RUN_TS_SQL = "TIMESTAMP '2025-06-01 00:00:00'"
# Incremental loads: what was loaded by a first run ending at this date.
FIRST_LOAD_BEFORE = dt.date(1998, 1, 1)
FIRST_LOAD_BEFORE_SQL = "DATE '1998-01-01'"

_RAW_CTE = """
per_day AS (
    SELECT s.s_nationkey AS n_nationkey, CAST(l.l_shipdate AS DATE) AS ship_day,
           SUM(CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity
                    WHEN l.l_linestatus = 'O' THEN l.l_quantity ELSE 0.0 END) AS units,
           SUM(CASE WHEN l.l_returnflag = 'R'
                    THEN CAST(l.l_quantity * l.l_discount AS DECIMAL(18,2)) END) AS lost
    FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
    GROUP BY 1, 2
),
raw AS (
    SELECT CASE WHEN r.r_name = 'MIDDLE EAST' THEN 'AGG_' || n.n_name
                WHEN r.r_name = 'AFRICA' AND p.ship_day < DATE '1996-01-01' THEN NULL
                ELSE 'N' || chr(65 + n.n_nationkey) || chr(65 + n.n_regionkey) END AS iso_code,
           n.n_name AS location, p.ship_day,
           p.units / 2.0 AS new_cases, CAST(p.lost AS DOUBLE) AS new_deaths
    FROM per_day p
    JOIN nation n ON p.n_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
),
staging AS (
    SELECT * FROM (
        SELECT iso_code, location AS country, CAST(ship_day AS TIMESTAMP) AS event_date,
               CAST(trunc(coalesce(new_cases, 0)) AS BIGINT) AS cases,
               CAST(trunc(coalesce(new_deaths, 0)) AS BIGINT) AS deaths,
               'Our World in Data' AS source_name,
               {run_ts} AS loaded_at
        FROM raw
        WHERE iso_code IS NOT NULL AND location IS NOT NULL AND ship_day IS NOT NULL
          AND length(iso_code) = 3
    ) WHERE cases >= 0 AND deaths >= 0
),
dd AS (
    SELECT CAST(row_number() OVER (ORDER BY full_date) AS BIGINT) AS date_id, full_date,
           CAST(year(full_date) AS INTEGER) AS year,
           CAST(quarter(full_date) AS INTEGER) AS quarter,
           CAST(month(full_date) AS INTEGER) AS month,
           strftime(full_date, '%B') AS month_name,
           CAST(weekofyear(full_date) AS INTEGER) AS week,
           strftime(full_date, '%A') AS day_of_week
    FROM (SELECT DISTINCT CAST(event_date AS DATE) AS full_date FROM staging
          WHERE event_date IS NOT NULL)
),
dl AS (
    SELECT CAST(row_number() OVER (ORDER BY iso_code) AS BIGINT) AS location_id, country,
           CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS continent, iso_code
    FROM (SELECT iso_code, min(country) AS country FROM staging
          WHERE iso_code IS NOT NULL GROUP BY iso_code)
),
facts AS (
    SELECT dd.date_id, dl.location_id, CAST(1 AS BIGINT) AS disease_id,
           CAST(1 AS BIGINT) AS source_id, CAST(s.cases AS INTEGER) AS cases,
           CAST(s.deaths AS INTEGER) AS deaths, CAST(0 AS INTEGER) AS recovered,
           s.loaded_at, dd.full_date
    FROM staging s
    JOIN dd ON dd.full_date = CAST(s.event_date AS DATE)
    JOIN dl ON dl.iso_code = s.iso_code
    WHERE s.cases > 0 OR s.deaths > 0
)
""".replace("{run_ts}", RUN_TS_SQL)


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_events(T.country_day_reports(spark, sf_dir), RUN_TS)


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging as the pipeline has it after L1: written once (to the
    checkpoint folder), then read by every later step instead of re-deriving
    it from lineitem for each dimension and the facts."""
    return materialize(_staging(spark, sf_dir), "staging")


def _dim_date(staging: DataFrame) -> DataFrame:
    return K.assign_keys(Cal.calendar_rows(staging, "event_date"), "date_id", ["full_date"]).select(
        *SC.DIM_DATE.fieldNames()
    )


def _dim_location(staging: DataFrame) -> DataFrame:
    spark = staging.sparkSession
    empty = spark.createDataFrame([], SC.DIM_LOCATION)
    incoming = staging.select(
        "iso_code",
        "country",
        F.lit(None).cast("string").alias("region"),
        F.lit(None).cast("string").alias("continent"),
    )
    return M.new_rows(empty, incoming, ["iso_code"], "location_id").select(*SC.DIM_LOCATION.fieldNames())


@register(
    "scan_project",
    """
SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem
""",
)
def scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A projected full scan; only the four columns are read."""
    return T.read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate"
    )


@register(
    "key_length_filter",
    """
SELECT p_partkey, p_brand FROM part WHERE length(p_brand) = 7
""",
)
def key_length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """keep rows whose code has exactly N characters."""
    part = T.read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return C.keep_code_length(part, "p_brand", 7)


@register("clean_rows", f"WITH {_RAW_CTE} SELECT * FROM staging")
def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning chain (F1 -> F2 -> F3 -> parse -> F4 -> P1 -> P2 -> P3)
    over the raw country-day extract derived from lineitem."""
    return _staging(spark, sf_dir).select(*SC.STAGING.fieldNames())


@register("csv_clean_rows", f"WITH {_RAW_CTE} SELECT * FROM staging")
def csv_clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1-S4 + C1: the same extract written as a folder of CSV files and read
    back by the projecting CSV scan before it is cleaned."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-csv-{uuid.uuid4().hex}"
    reports = T.country_day_reports(spark, sf_dir)
    reports.select(F.lit("unused").alias("extra"), "*").write.option("header", True).csv(path)
    return C.clean_events(read_csv_projected(spark, path), RUN_TS).select(*SC.STAGING.fieldNames())


@register("date_dimension", f"WITH {_RAW_CTE} SELECT * FROM dd")
def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 + A9 + L4: distinct staging dates with calendar attributes and dense
    surrogate keys in date order."""
    return _dim_date(_staged(spark, sf_dir))


@register("dim_location_load", f"WITH {_RAW_CTE} SELECT * FROM dl")
def dim_location_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: insert-new-only location load from staging (first country per code
    wins, deterministically the smallest)."""
    return _dim_location(_staged(spark, sf_dir))


@register(
    "fact_load",
    f"""
WITH {_RAW_CTE}
SELECT date_id, location_id, disease_id, source_id, cases, deaths, recovered, loaded_at FROM facts
""",
)
def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 (+ J4, J5, F7, P4, L9): staging joined to both dimensions, rows with
    no cases and no deaths dropped, constant disease/source keys."""
    staging = _staged(spark, sf_dir)
    return F_.build_facts(staging, _dim_date(staging), _dim_location(staging))


def _two_loads(spark: SparkSession, sf_dir: str, on_conflict: str) -> tuple[DataFrame, DataFrame]:
    """A first load up to FIRST_LOAD_BEFORE and a second one of everything.
    The first is written, as a load writes it, before its ids and keys are
    looked at by the second."""
    staging = _staged(spark, sf_dir)
    dd, dl = _dim_date(staging), _dim_location(staging)
    first = F_.build_facts(staging.where(F.col("event_date") < F.lit(FIRST_LOAD_BEFORE)), dd, dl)
    loaded = materialize(F_.load_facts(first, None, "append"), "facts")
    return loaded, F_.load_facts(F_.build_facts(staging, dd, dl), loaded, on_conflict)


def _after_two_loads(spark: SparkSession, sf_dir: str, on_conflict: str) -> DataFrame:
    loaded, second = _two_loads(spark, sf_dir, on_conflict)
    return loaded.unionByName(second).select(*F_.FACT_COLUMNS)


@register(
    "fact_ids",
    f"""
WITH {_RAW_CTE},
n AS (SELECT count(*) AS b, count_if(full_date < {FIRST_LOAD_BEFORE_SQL}) AS a FROM facts)
SELECT 1 AS load, a AS fact_rows, a AS distinct_ids, CAST(0 AS BIGINT) AS not_above_earlier FROM n
UNION ALL SELECT 2, b, b, CAST(0 AS BIGINT) FROM n
""",
)
def fact_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of two loads are unique and the second's lie above the
    first's."""
    loaded, second = _two_loads(spark, sf_dir, "append")
    second = materialize(second, "facts")
    mark = K.max_id(loaded, "event_id")

    def told(load: int, rows: DataFrame, above: int) -> DataFrame:
        return rows.agg(
            F.lit(load).alias("load"),
            F.count(F.lit(1)).alias("fact_rows"),
            F.count_distinct("event_id").alias("distinct_ids"),
            F.count_if(F.col("event_id") <= above).alias("not_above_earlier"),
        )

    return told(1, loaded, 0).unionByName(told(2, second, mark))


@register(
    "load_orphans",
    f"""
WITH {_RAW_CTE}
SELECT 'fk_date_id' AS check_name, count_if(full_date >= {FIRST_LOAD_BEFORE_SQL}) AS violations FROM facts
UNION ALL SELECT 'fk_location_id', count_if(location_id NOT IN
    (SELECT location_id FROM dl WHERE iso_code < 'NM')) FROM facts
UNION ALL SELECT 'fk_disease_id', count_if(disease_id NOT IN (SELECT r_regionkey FROM region)) FROM facts
UNION ALL SELECT 'fk_source_id', count_if(source_id NOT IN
    (SELECT n_nationkey FROM nation WHERE n_nationkey > 1)) FROM facts
""",
)
def load_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The references a load checks before its append, against
    dimensions that lack some of the rows."""
    staging = _staged(spark, sf_dir)
    dd, dl = materialize(_dim_date(staging), "dim"), materialize(_dim_location(staging), "dim")
    facts = materialize(F_.build_facts(staging, dd, dl), "facts")
    nations = T.read_table(spark, sf_dir, "nation").where("n_nationkey > 1")
    return Q.constraint_checks(
        facts,
        foreign_keys=[
            ("date_id", dd.where(F.col("full_date") < F.lit(FIRST_LOAD_BEFORE)), "date_id"),
            ("location_id", dl.where(F.col("iso_code") < "NM"), "location_id"),
            ("disease_id", T.read_table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("k")), "k"),
            ("source_id", nations.select(F.col("n_nationkey").cast("bigint").alias("k")), "k"),
        ],
    )


@register(
    "fact_load_append",
    f"""
WITH {_RAW_CTE}
SELECT date_id, location_id, disease_id, source_id, cases, deaths, recovered, loaded_at
FROM facts WHERE full_date < {FIRST_LOAD_BEFORE_SQL}
UNION ALL
SELECT date_id, location_id, disease_id, source_id, cases, deaths, recovered, loaded_at FROM facts
""",
)
def fact_load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 as coded: a second load appends every fact again (the fact has no
    unique key, so nothing conflicts)."""
    return _after_two_loads(spark, sf_dir, "append")


@register(
    "fact_load_ignore",
    f"""
WITH {_RAW_CTE},
first AS (SELECT * FROM facts WHERE full_date < {FIRST_LOAD_BEFORE_SQL})
SELECT date_id, location_id, disease_id, source_id, cases, deaths, recovered, loaded_at FROM first
UNION ALL
SELECT f.date_id, f.location_id, f.disease_id, f.source_id, f.cases, f.deaths, f.recovered, f.loaded_at
FROM facts f
WHERE NOT EXISTS (SELECT 1 FROM first x
                  WHERE x.date_id = f.date_id AND x.location_id = f.location_id
                    AND x.disease_id = f.disease_id AND x.source_id = f.source_id)
""",
)
def fact_load_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 as intended: the second load skips facts whose natural key is
    already loaded, so a rerun adds only the new days."""
    return _after_two_loads(spark, sf_dir, "ignore")


# Customer dimension, loaded incrementally: a first load holds customers who
# ordered before FIRST_LOAD_BEFORE (nation/region not yet known); the second
# load brings every customer who ordered, with nation and region.

_CUSTOMER_DIM_CTE = f"""
existing AS (
    SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS customer_id,
           c_custkey, c_name, CAST(NULL AS VARCHAR) AS nation, CAST(NULL AS VARCHAR) AS region
    FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate < {FIRST_LOAD_BEFORE_SQL})
),
incoming AS (
    SELECT c.c_custkey, c.c_name, n.n_name AS nation, r.r_name AS region
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE c.c_custkey IN (SELECT o_custkey FROM orders)
),
added AS (
    SELECT (SELECT coalesce(max(customer_id), 0) FROM existing)
               + CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS customer_id,
           c_custkey, c_name, nation, region
    FROM incoming i
    WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.c_custkey = i.c_custkey)
)
"""


def _customer_dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = T.read_table(spark, sf_dir, "customer")
    orders = T.read_table(spark, sf_dir, "orders")
    # semi joins look keys up in orders, where one customer may own a third of
    # all rows: de-duplicate the lookup side first (map-side partial
    # aggregate), since a skewed build side cannot be split at run time
    early = (
        orders.where(F.col("o_orderdate") < F.lit(FIRST_LOAD_BEFORE))
        .select(F.col("o_custkey").alias("c_custkey"))
        .distinct()
    )
    ordered_any = orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
    existing = K.assign_keys(
        customer.join(early, "c_custkey", "left_semi").select(
            "c_custkey",
            "c_name",
            F.lit(None).cast("string").alias("nation"),
            F.lit(None).cast("string").alias("region"),
        ),
        "customer_id",
        ["c_custkey"],
    ).select("customer_id", "c_custkey", "c_name", "nation", "region")
    geo = T.locations(spark, sf_dir).select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.col("country").alias("nation"),
        F.col("continent").alias("region"),
    )
    incoming = (
        customer.join(ordered_any, "c_custkey", "left_semi")
        .join(geo, "c_nationkey")
        .select("c_custkey", "c_name", "nation", "region")
    )
    return existing, incoming


@register(
    "dim_insert_new",
    f"""
WITH {_CUSTOMER_DIM_CTE}
SELECT * FROM existing UNION ALL SELECT * FROM added
""",
)
def dim_insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2/L3 + J6 on a growing dimension: keys already present are skipped
    (their NULL attributes stay), new keys get ids after the maximum."""
    existing, incoming = _customer_dims(spark, sf_dir)
    return M.insert_new(existing, incoming, ["c_custkey"], "customer_id")


@register(
    "dim_upsert",
    f"""
WITH {_CUSTOMER_DIM_CTE}
SELECT e.customer_id, e.c_custkey, e.c_name,
       CASE WHEN i.c_custkey IS NOT NULL THEN i.nation ELSE e.nation END AS nation,
       CASE WHEN i.c_custkey IS NOT NULL THEN i.region ELSE e.region END AS region
FROM existing e LEFT JOIN incoming i ON e.c_custkey = i.c_custkey
UNION ALL
SELECT * FROM added
""",
)
def dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L7 + J7: matched keys keep id and name and take the incoming nation and
    region; unmatched keys are inserted with new ids."""
    existing, incoming = _customer_dims(spark, sf_dir)
    return M.upsert(existing, incoming, ["c_custkey"], ["nation", "region"], "customer_id")


# ==========================================================================
# Data quality, constraints, run metrics
# ==========================================================================

_CHECK_COLS = ("check_name", "passed", "metric", "threshold")


def _checks_sql(rows: list[tuple[str, str, str, str]], ctes: str, source: str) -> str:
    selects = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS check_name, {passed} AS passed, CAST({metric} AS DOUBLE) AS metric, "
        f"CAST({threshold} AS DOUBLE) AS threshold FROM {source}"
        for name, passed, metric, threshold in rows
    )
    return f"WITH {ctes}\n{selects}"


_SUITE_AGG = f"""
a AS (
    SELECT count(*) AS n,
           count_if(iso_code IS NULL) AS iso_nulls,
           count_if(event_date IS NULL) AS date_nulls,
           count_if(cases IS NULL) AS case_nulls,
           count_if(cases < 0) AS neg_cases,
           count_if(deaths < 0) AS neg_deaths,
           count_if(event_date > {RUN_TS_SQL} + INTERVAL 1 DAY) AS future,
           count_if(NOT coalesce(regexp_full_match(iso_code, '[A-Z]{{3}}'), false)) AS bad_codes,
           count(DISTINCT iso_code) AS codes,
           count_if(coalesce(length(iso_code), -1) <> 3) AS bad_len,
           max(event_date) AS max_date
    FROM staging
),
d AS (SELECT count(*) AS k FROM staging GROUP BY iso_code, event_date),
ad AS (
    SELECT a.*, (SELECT coalesce(sum(k), 0) FROM d) AS rows,
           (SELECT coalesce(sum(k - 1), 0) FROM d) AS dups
    FROM a
)
"""


def _rate(num: str, den: str, empty: str) -> str:
    return f"CASE WHEN {den} > 0 THEN {num} / {den} ELSE {empty} END"


@register(
    "quality_suite",
    _checks_sql(
        [
            ("not_empty", "n >= 100", "n", "100"),
            ("required_columns", "true", "0", "0"),
            ("null_rate_iso_code", f"{_rate('iso_nulls', 'n', '1.0')} <= 0.0", _rate("iso_nulls", "n", "1.0"), "0.0"),
            ("null_rate_event_date", f"{_rate('date_nulls', 'n', '1.0')} <= 0.0", _rate("date_nulls", "n", "1.0"), "0.0"),
            ("null_rate_cases", f"{_rate('case_nulls', 'n', '1.0')} <= 0.1", _rate("case_nulls", "n", "1.0"), "0.1"),
            ("no_negatives_cases", "neg_cases = 0", "neg_cases", "0"),
            ("no_negatives_deaths", "neg_deaths = 0", "neg_deaths", "0"),
            ("date_range", "future = 0", "future", "1"),
            ("iso_code_format", "bad_codes = 0", "bad_codes", "0"),
            ("unique_combinations", f"{_rate('dups', 'rows', '0.0')} <= 0.01", _rate("dups", "rows", "0.0"), "0.01"),
            ("country_coverage", "codes >= 50", "codes", "50"),
        ],
        _RAW_CTE + "," + _SUITE_AGG,
        "ad",
    ),
)
def quality_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V11 (V1-V4, V6, V8-V10): the 11-check validation suite over staging,
    one aggregate job plus one groupBy job."""
    staging = _staged(spark, sf_dir)
    return Q.run_checks(staging, Q.health_suite(staging, RUN_TS)).select(*_CHECK_COLS)


@register(
    "gate",
    _checks_sql(
        [
            ("gate_not_empty", "n >= 1", "n", "1"),
            ("gate_required_columns", "true", "0", "0"),
            ("gate_no_negative_cases", "neg_cases = 0", "neg_cases", "0"),
            ("gate_iso_code_length", "bad_len = 0", "bad_len", "0"),
            (
                "gate_iso_code_null_rate",
                "NOT coalesce(iso_nulls / NULLIF(n, 0) > 0.01, false)",
                "iso_nulls / NULLIF(n, 0)",
                "0.01",
            ),
            (
                "gate_future_dates",
                f"NOT coalesce(max_date > {RUN_TS_SQL} + INTERVAL 1 DAY, false)",
                f"CASE WHEN coalesce(max_date > {RUN_TS_SQL} + INTERVAL 1 DAY, false) THEN 1.0 ELSE 0.0 END",
                "1",
            ),
        ],
        _RAW_CTE + "," + _SUITE_AGG,
        "a",
    ),
)
def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: the six pipeline-gate rules over staging, with their quirks."""
    staging = _staging(spark, sf_dir)
    return Q.run_checks(staging, Q.gate_specs(staging, RUN_TS)).select(*_CHECK_COLS)


@register(
    "quality_customer",
    _checks_sql(
        [
            ("not_empty", "n >= 100", "n", "100"),
            ("null_rate_c_mktsegment", f"{_rate('seg_nulls', 'n', '1.0')} <= 0.05", _rate("seg_nulls", "n", "1.0"), "0.05"),
            ("no_negatives_c_acctbal", "neg = 0", "neg", "0"),
            ("unique_combinations", f"{_rate('dups', 'rows', '0.0')} <= 0.01", _rate("dups", "rows", "0.0"), "0.01"),
            ("nation_coverage", "nations >= 50", "nations", "50"),
        ],
        """
c AS (SELECT c_custkey, c_nationkey, c_acctbal, NULLIF(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment
      FROM customer),
a AS (SELECT count(*) AS n, count_if(c_mktsegment IS NULL) AS seg_nulls,
             count_if(c_acctbal < 0) AS neg, count(DISTINCT c_nationkey) AS nations FROM c),
d AS (SELECT count(*) AS k FROM c GROUP BY c_nationkey, c_mktsegment),
ad AS (SELECT a.*, (SELECT coalesce(sum(k), 0) FROM d) AS rows,
              (SELECT coalesce(sum(k - 1), 0) FROM d) AS dups FROM a)
""",
        "ad",
    ),
)
def quality_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, V3, V4, V9, V10 on customer (a NULL path injected with NULLIF):
    negative balances, NULL segments, duplicate (nation, segment) pairs."""
    c = T.read_table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_nationkey",
        "c_acctbal",
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("c_mktsegment"),
    )
    specs = [
        Q.not_empty(c, 100),
        Q.null_rate(c, "c_mktsegment", 0.05),
        Q.no_negatives(c, "c_acctbal"),
        Q.unique_combinations(c, ["c_nationkey", "c_mktsegment"], 0.01),
        Q.coverage(c, "c_nationkey", 50, name="nation_coverage"),
    ]
    return Q.run_checks(c, specs).select(*_CHECK_COLS)


EVENTS_NOW = dt.datetime(2024, 1, 15)


@register(
    "quality_events",
    _checks_sql(
        [
            ("date_range", "future = 0", "future", "1"),
            ("null_rate_value", f"{_rate('value_nulls', 'n', '1.0')} <= 0.0", _rate("value_nulls", "n", "1.0"), "0.0"),
            ("event_type_format", "bad = 0", "bad", "0"),
            ("unique_combinations", f"{_rate('dups', 'rows', '0.0')} <= 0.01", _rate("dups", "rows", "0.0"), "0.01"),
        ],
        """
a AS (SELECT count(*) AS n,
             count_if(ts > TIMESTAMP '2024-01-15 00:00:00' + INTERVAL 1 DAY) AS future,
             count_if(value IS NULL OR isnan(value)) AS value_nulls,
             count_if(NOT coalesce(regexp_full_match(event_type, '[A-Z]{3}'), false)) AS bad
      FROM events),
d AS (SELECT count(*) AS k FROM events GROUP BY user_id, ts),
ad AS (SELECT a.*, (SELECT coalesce(sum(k), 0) FROM d) AS rows,
              (SELECT coalesce(sum(k - 1), 0) FROM d) AS dups FROM a)
""",
        "ad",
    ),
)
def quality_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6, V3 (NaN as NULL), V8, V9 on the event log with an injected clock."""
    ev = T.read_table(spark, sf_dir, "events")
    specs = [
        Q.date_range(ev, "ts", EVENTS_NOW, 1),
        Q.null_rate(ev, "value", 0.0),
        Q.code_format(ev, "event_type", name="event_type_format"),
        Q.unique_combinations(ev, ["user_id", "ts"], 0.01),
    ]
    return Q.run_checks(ev, specs).select(*_CHECK_COLS)


@register(
    "constraint_checks",
    """
SELECT 'lineitem_not_null_l_orderkey' AS check_name, CAST(count_if(l_orderkey IS NULL) AS BIGINT) AS violations FROM lineitem
UNION ALL SELECT 'lineitem_not_null_l_partkey', CAST(count_if(l_partkey IS NULL) AS BIGINT) FROM lineitem
UNION ALL SELECT 'lineitem_unique_l_orderkey_l_linenumber', CAST(count(*) AS BIGINT) FROM
    (SELECT 1 FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
     GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'lineitem_fk_l_orderkey', CAST(count(*) AS BIGINT) FROM lineitem l
    WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL SELECT 'lineitem_fk_l_partkey', CAST(count(*) AS BIGINT) FROM lineitem l
    WHERE l.l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL SELECT 'lineitem_fk_l_suppkey', CAST(count(*) AS BIGINT) FROM lineitem l
    WHERE l.l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)
UNION ALL SELECT 'orders_not_null_o_custkey', CAST(count_if(o_custkey IS NULL) AS BIGINT) FROM orders
UNION ALL SELECT 'orders_unique_o_orderkey', CAST(count(*) AS BIGINT) FROM
    (SELECT 1 FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'orders_fk_o_custkey', CAST(count(*) AS BIGINT) FROM orders o
    WHERE o.o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
""",
)
def constraint_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V12 + J8: NOT NULL, UNIQUE and REFERENCES checked as queries."""
    li = T.read_table(spark, sf_dir, "lineitem")
    orders = T.read_table(spark, sf_dir, "orders")
    a = Q.constraint_checks(
        li,
        not_null=["l_orderkey", "l_partkey"],
        unique=[["l_orderkey", "l_linenumber"]],
        foreign_keys=[
            ("l_orderkey", orders, "o_orderkey"),
            ("l_partkey", T.read_table(spark, sf_dir, "part"), "p_partkey"),
            ("l_suppkey", T.read_table(spark, sf_dir, "supplier"), "s_suppkey"),
        ],
        prefix="lineitem_",
    )
    b = Q.constraint_checks(
        orders,
        not_null=["o_custkey"],
        unique=[["o_orderkey"]],
        foreign_keys=[("o_custkey", T.read_table(spark, sf_dir, "customer"), "c_custkey")],
        prefix="orders_",
    )
    return a.unionByName(b)


@register(
    "run_metrics",
    """
SELECT count(*) AS row_count,
       count(DISTINCT user_id) AS distinct_user_id,
       count(DISTINCT event_type) AS distinct_event_type,
       min(ts) AS min_ts, max(ts) AS max_ts,
       CAST(count_if(event_type = 'error') AS BIGINT) AS error_events,
       CAST(count_if(value < 0) AS BIGINT) AS negative_values,
       count_if(value IS NULL OR isnan(value)) / NULLIF(count(*), 0) AS null_rate_value
FROM events
""",
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4-A8 (+ G3's shape/range/coverage profile) in one aggregate job."""
    ev = T.read_table(spark, sf_dir, "events")
    return P.profile(
        ev,
        distinct=["user_id", "event_type"],
        min_max=["ts"],
        conditions={
            "error_events": F.col("event_type") == F.lit("error"),
            "negative_values": F.col("value") < F.lit(0),
        },
        null_rates=["value"],
    )


# ==========================================================================
# Further single-operator queries
# ==========================================================================


@register(
    "date_dimension_padded",
    """
SELECT CAST(row_number() OVER (ORDER BY full_date) AS BIGINT) AS date_id, full_date,
       CAST(year(full_date) AS INTEGER) AS year,
       CAST(quarter(full_date) AS INTEGER) AS quarter,
       CAST(month(full_date) AS INTEGER) AS month,
       rpad(strftime(full_date, '%B'), 9, ' ') AS month_name,
       CAST(weekofyear(full_date) AS INTEGER) AS week,
       rpad(strftime(full_date, '%A'), 9, ' ') AS day_of_week
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM orders WHERE o_orderdate IS NOT NULL)
""",
)
def date_dimension_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 with the loader's ``TO_CHAR`` blank-padded month and day names (D13),
    over every order date."""
    orders = T.read_table(spark, sf_dir, "orders").select("o_orderdate")
    rows = Cal.calendar_rows(orders, "o_orderdate", pad_names=True)
    return K.assign_keys(rows, "date_id", ["full_date"]).select(*SC.DIM_DATE.fieldNames())


@register(
    "staging_unmatched",
    f"""
WITH {_RAW_CTE},
first_dates AS (SELECT DISTINCT CAST(event_date AS DATE) AS d FROM staging
                WHERE event_date < {FIRST_LOAD_BEFORE_SQL}),
first_codes AS (SELECT DISTINCT iso_code FROM staging WHERE event_date < {FIRST_LOAD_BEFORE_SQL})
SELECT * FROM staging s
WHERE CAST(s.event_date AS DATE) NOT IN (SELECT d FROM first_dates)
   OR s.iso_code NOT IN (SELECT iso_code FROM first_codes)
""",
)
def staging_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging rows the fact joins would silently drop, against
    dimensions that hold only what a first load (before 1998) created."""
    staging = _staged(spark, sf_dir)
    first = staging.where(F.col("event_date") < F.lit(FIRST_LOAD_BEFORE))
    return F_.unmatched_staging(staging, _dim_date(first), _dim_location(first)).select(
        *SC.STAGING.fieldNames()
    )


@register(
    "negative_sample",
    """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 5
""",
)
def negative_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five offending rows of a failed no-negatives check
    (the limit is the feature: a sample for the report)."""
    customer = T.read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return Q.negative_sample(customer, "c_acctbal", ["c_custkey"])


# One query per check (V3, V4, V6, V8, V9, V10), each on a whole table.

ORDERS_NOW = dt.datetime(1998, 1, 1)


def _one_check_sql(name: str, passed: str, metric: str, threshold: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, {passed} AS passed, CAST({metric} AS DOUBLE) AS metric, "
        f"CAST({threshold} AS DOUBLE) AS threshold FROM ({source})"
    )


@register(
    "null_rate",
    _one_check_sql(
        "null_rate_o_orderpriority",
        f"{_rate('nulls', 'n', '1.0')} <= 0.05",
        _rate("nulls", "n", "1.0"),
        "0.05",
        "SELECT count(*) AS n, count_if(NULLIF(o_orderpriority, '5-LOW') IS NULL) AS nulls FROM orders",
    ),
)
def null_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 on orders, with a NULL path injected by NULLIF."""
    o = T.read_table(spark, sf_dir, "orders").select(
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority")
    )
    return Q.run_checks(o, [Q.null_rate(o, "o_orderpriority", 0.05)]).select(*_CHECK_COLS)


@register(
    "negatives",
    _one_check_sql(
        "no_negatives_c_acctbal", "neg = 0", "neg", "0",
        "SELECT count_if(c_acctbal < 0) AS neg FROM customer",
    ),
)
def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 on customer balances."""
    c = T.read_table(spark, sf_dir, "customer").select("c_acctbal")
    return Q.run_checks(c, [Q.no_negatives(c, "c_acctbal")]).select(*_CHECK_COLS)


@register(
    "date_range",
    _one_check_sql(
        "date_range", "future = 0", "future", "1",
        "SELECT count_if(o_orderdate > TIMESTAMP '1998-01-01 00:00:00' + INTERVAL 1 DAY) AS future FROM orders",
    ),
)
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 on order dates with an injected clock."""
    o = T.read_table(spark, sf_dir, "orders").select("o_orderdate")
    return Q.run_checks(o, [Q.date_range(o, "o_orderdate", ORDERS_NOW, 1)]).select(*_CHECK_COLS)


@register(
    "code_format",
    _one_check_sql(
        "priority_code_format", "bad = 0", "bad", "0",
        "SELECT count_if(NOT coalesce(regexp_full_match(upper(split_part(substr(o_orderpriority, 3), ' ', 1)), "
        "'[A-Z]{3}'), false)) AS bad FROM orders",
    ),
)
def code_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8 on a code derived from the order priority (its first word)."""
    o = T.read_table(spark, sf_dir, "orders").select(
        F.upper(F.split_part(F.substr("o_orderpriority", F.lit(3)), F.lit(" "), F.lit(1))).alias("code")
    )
    return Q.run_checks(o, [Q.code_format(o, "code", name="priority_code_format")]).select(*_CHECK_COLS)


@register(
    "duplicates",
    _one_check_sql(
        "unique_combinations",
        f"{_rate('dups', 'rows', '0.0')} <= 0.01",
        _rate("dups", "rows", "0.0"),
        "0.01",
        "SELECT coalesce(sum(k), 0) AS rows, coalesce(sum(k - 1), 0) AS dups "
        "FROM (SELECT count(*) AS k FROM orders GROUP BY o_custkey, o_orderdate)",
    ),
)
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9 / A10: rows beyond the first per (customer, order date)."""
    o = T.read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    return Q.run_checks(o, [Q.unique_combinations(o, ["o_custkey", "o_orderdate"], 0.01)]).select(*_CHECK_COLS)


@register(
    "coverage",
    _one_check_sql(
        "supplier_coverage", "n >= 50", "n", "50",
        "SELECT count(DISTINCT l_suppkey) AS n FROM lineitem",
    ),
)
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct suppliers seen in lineitem."""
    li = T.read_table(spark, sf_dir, "lineitem").select("l_suppkey")
    return Q.run_checks(li, [Q.coverage(li, "l_suppkey", 50, name="supplier_coverage")]).select(*_CHECK_COLS)


# Details, recency, stage counts and refused batches ------------------------


def _detail_sql(rows: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS check_name, '{k}' AS detail, CAST({v} AS DOUBLE) AS value FROM ad" for c, k, v in rows)


@register(
    "quality_details",
    f"WITH {_RAW_CTE}, {_SUITE_AGG} "
    + _detail_sql(
        [
            ("not_empty", "row_count", "n"),
            *[
                (f"null_rate_{c}", k, v)
                for c, nulls, most in (("iso_code", "iso_nulls", "0.0"), ("event_date", "date_nulls", "0.0"), ("cases", "case_nulls", "0.1"))
                for k, v in (("null_count", nulls), ("row_count", "n"), ("null_rate", _rate(nulls, "n", "1.0")), ("max_allowed", most))
            ],
            ("no_negatives_cases", "negative_count", "neg_cases"),
            ("no_negatives_deaths", "negative_count", "neg_deaths"),
            ("date_range", "future_count", "future"),
            ("iso_code_format", "invalid_count", "bad_codes"),
            ("unique_combinations", "duplicate_count", "dups"),
            ("unique_combinations", "row_count", "rows"),
            ("unique_combinations", "duplicate_rate", _rate("dups", "rows", "0.0")),
            ("country_coverage", "country_count", "codes"),
            ("country_coverage", "min_required", "50"),
        ]
    ),
)
def quality_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: the numbers behind each result of the validation suite."""
    staging = _staged(spark, sf_dir)
    results = Q.run_checks(staging, Q.health_suite(staging, RUN_TS))
    rows = results.select("check_name", F.explode("details").alias("detail", "text"))
    return rows.select("check_name", "detail", F.expr("try_cast(text AS DOUBLE)").alias("value")).where("value IS NOT NULL")


@register(
    "negative_details",
    """
SELECT 'no_negatives_c_acctbal' AS check_name, count_if(c_acctbal < 0) AS negative_count,
       CAST(least(5, count_if(c_acctbal < 0)) AS INTEGER) AS sampled_rows
FROM customer
""",
)
def negative_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 inside V4: a failed check carries five of the offending rows."""
    c = T.read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    row = Q.run_checks(c, [Q.no_negatives(c, "c_acctbal")])
    sampled = F.from_json(F.col("details")[Q.SAMPLE_KEY], "array<struct<c_custkey: bigint, c_acctbal: double>>")
    return row.select(
        "check_name",
        F.col("details")["negative_count"].cast("bigint").alias("negative_count"),
        F.size(F.filter(F.coalesce(sampled, F.array()), lambda x: x["c_acctbal"] < 0)).alias("sampled_rows"),
    )


RECENT_DAYS = 900


@register(
    "recent_orders",
    f"""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00' - INTERVAL {RECENT_DAYS} DAY
""",
)
def recent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders of the last days before an injected clock."""
    orders = T.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return C.keep_recent(orders, "o_orderdate", dt.datetime(2000, 1, 1), RECENT_DAYS)


@register(
    "stage_counts",
    f"""
WITH {_RAW_CTE},
kept AS (SELECT * FROM raw WHERE iso_code IS NOT NULL AND location IS NOT NULL AND ship_day IS NOT NULL)
SELECT 'extract' AS stage, count(*) AS kept_rows FROM raw
UNION ALL SELECT 'drop_nulls', count(*) FROM kept
UNION ALL SELECT 'code_length', count_if(length(iso_code) = 3) FROM kept
UNION ALL SELECT 'non_negative', count(*) FROM staging
""",
)
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after each stage of the clean chain, observed while it runs."""
    seen: dict = {}
    C.clean_events(T.country_day_reports(spark, sf_dir), RUN_TS, observations=seen).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(P.observed_counts(seen).items()), "stage string, kept_rows bigint")


@register(
    "refused_batch_keys",
    """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
)
def refused_batch_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys for which an upsert batch would be refused."""
    return M.duplicate_keys(T.read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# The queries of loads register themselves; they build on this module.
from quarry.plans import driver_loads  # noqa: E402, F401
