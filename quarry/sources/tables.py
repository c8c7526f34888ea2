"""Table scans (S5, S8) and the domain-neutral views the driver queries use.

The driver's tables are TPC-H-like.  The health star maps onto them as:

- fact event       = one ``lineitem`` row
- event date       = the order's ``o_orderdate`` (day)
- location         = the customer's nation (country) and region (continent)
- disease          = the part (``p_name``; category ``p_type``)
- cases            = units (``l_quantity``), deaths = units returned
  (``l_returnflag = 'R'``), recovered = units of finished lines (``'F'``)

``country_day_reports`` derives the raw extract the ELT consumes (one report
per supplier nation and ship day, like a country-day CSV) from ``lineitem``
so that its work grows with the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Joins here carry no broadcast hints: nation and region are tiny Parquet
# tables whose file-size statistics let the planner broadcast them on its own,
# while customer, supplier, part and orders grow with the data and are joined
# by shuffle unless AQE measures them small at run time.


# The input tables' schemas.  Declaring them skips schema
# inference from file footers at every read.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full scan of one driver table (S5) with its declared schema; projection
    and filters applied later are pushed into the Parquet scan by Catalyst."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def footer_aggregates(spark: SparkSession, path: str, min_max: Sequence[str] = ()) -> DataFrame:
    """One row from the Parquet footers (A4, A6, L12): ``row_count`` and
    ``min_<c>``/``max_<c>``.  Spark's V2 scan answers COUNT, MIN and MAX of
    numbers and dates from the footers' statistics and reads no data page; a
    file without statistics is an error there.  The scan is chosen in a
    session of its own, so the caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    bounds = [f(c).alias(f"{name}_{c}") for c in min_max for name, f in (("min", F.min), ("max", F.max))]
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"), *bounds)


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as the event fact: keys plus integer measures."""
    cases = F.col("l_quantity").cast("bigint")
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        cases.alias("cases"),
        F.when(F.col("l_returnflag") == "R", cases).otherwise(F.lit(0).cast("bigint")).alias("deaths"),
        F.when(F.col("l_linestatus") == "F", cases).otherwise(F.lit(0).cast("bigint")).alias("recovered"),
    )


def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("event_date")
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation x region: country and continent per nation key."""
    nation = read_table(spark, sf_dir, "nation").select(
        "n_nationkey", F.col("n_name").alias("country"), "n_regionkey"
    )
    region = read_table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("continent")
    )
    return nation.join(region, "n_regionkey")


def customer_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> (country, continent)."""
    customer = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    return customer.join(locations(spark, sf_dir), "n_nationkey")


def diseases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("disease_name"),
        F.col("p_type").alias("disease_type"),
    )


def country_day_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw country-day extract derived from ``lineitem``: one report per
    (supplier nation, ship day), every field a string as in a CSV, with the
    usual defects of such feeds: region-level aggregate rows with long codes,
    missing codes, missing and fractional counts, negative corrections.

    ``new_cases``  = units of open lines minus units of returned lines
    ``new_deaths`` = returned units x discount, summed as DECIMAL (missing when
                     nothing was returned that day)
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    supplier = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey")
    )
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "n_regionkey", "r_name"
    )
    returned = F.col("l_returnflag") == "R"
    per_day = (
        li.join(supplier, "l_suppkey")
        .groupBy("n_nationkey", F.to_date("l_shipdate").alias("ship_day"))
        .agg(
            F.sum(
                F.when(returned, -F.col("l_quantity"))
                .when(F.col("l_linestatus") == "O", F.col("l_quantity"))
                .otherwise(F.lit(0.0))
            ).alias("units"),
            F.sum(
                F.when(returned, (F.col("l_quantity") * F.col("l_discount")).cast("decimal(18,2)"))
            ).alias("lost"),
        )
    )
    code = (
        F.when(F.col("r_name") == "MIDDLE EAST", F.concat(F.lit("AGG_"), F.col("n_name")))
        .when((F.col("r_name") == "AFRICA") & (F.col("ship_day") < F.lit("1996-01-01").cast("date")), F.lit(None))
        .otherwise(
            F.concat(
                F.lit("N"),
                F.expr("chr(65 + n_nationkey)"),
                F.expr("chr(65 + n_regionkey)"),
            )
        )
    )
    return per_day.join(geo, "n_nationkey").select(
        code.cast("string").alias("iso_code"),
        F.col("n_name").alias("location"),
        F.date_format("ship_day", "yyyy-MM-dd").alias("date"),
        (F.col("units") / F.lit(2.0)).cast("string").alias("new_cases"),
        F.col("lost").cast("string").alias("new_deaths"),
    )


def supplier_day_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A finer raw extract for the end-to-end pipeline benchmark: one report
    per (supplier, ship day), i.e. about one row per two line items.  The
    three-letter code is the supplier key written in base 26 (A-Z), the
    location is the supplier name; counts follow ``country_day_reports``."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    supplier = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name")
    )
    returned = F.col("l_returnflag") == "R"
    per_day = li.groupBy("l_suppkey", F.to_date("l_shipdate").alias("ship_day")).agg(
        F.sum(
            F.when(returned, -F.col("l_quantity"))
            .when(F.col("l_linestatus") == "O", F.col("l_quantity"))
            .otherwise(F.lit(0.0))
        ).alias("units"),
        F.sum(
            F.when(returned, (F.col("l_quantity") * F.col("l_discount")).cast("decimal(18,2)"))
        ).alias("lost"),
    )
    code = F.concat(
        F.expr("chr(65 + CAST(pmod(l_suppkey DIV 676, 26) AS INT))"),
        F.expr("chr(65 + CAST(pmod(l_suppkey DIV 26, 26) AS INT))"),
        F.expr("chr(65 + CAST(pmod(l_suppkey, 26) AS INT))"),
    )
    return per_day.join(supplier, "l_suppkey").select(
        code.alias("iso_code"),
        F.col("s_name").alias("location"),
        F.date_format("ship_day", "yyyy-MM-dd").alias("date"),
        (F.col("units") / F.lit(2.0)).cast("string").alias("new_cases"),
        F.col("lost").cast("string").alias("new_deaths"),
    )
