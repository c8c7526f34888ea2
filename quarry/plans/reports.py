"""The warehouse's analytic statements (C3-C8, L7) over the health star's own
schema (``fact_health_events`` + ``dim_*``), composed from the generic
operators.  Pass tables from ``Warehouse.table`` or any DataFrames with the
same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import analytics as A
from quarry.operators.joins import star_join
from quarry.operators.merge import upsert


def _with_dims(fact: DataFrame, dims: list[tuple[DataFrame, str]]) -> DataFrame:
    # dimensions of the health star are bounded (calendar, countries,
    # diseases): broadcast after a size check
    return star_join(fact, dims)


def star_report(
    fact: DataFrame, dim_date: DataFrame, dim_location: DataFrame, dim_disease: DataFrame
) -> DataFrame:
    """Readable star join with the death rate, highest cases first."""
    joined = _with_dims(
        fact,
        [
            (dim_date.select("date_id", "full_date"), "date_id"),
            (dim_location.select("location_id", "country", "continent"), "location_id"),
            (dim_disease.select("disease_id", "disease_name", "category"), "disease_id"),
        ],
    )
    rated = A.death_rate(joined, "deaths", "cases")
    return A.order_desc(rated, "cases", ["event_id"]).select(
        F.col("full_date").alias("event_date"),
        "country",
        "continent",
        "disease_name",
        F.col("category").alias("disease_type"),
        "cases",
        "deaths",
        "recovered",
        "death_rate_pct",
    )


def rank_lag_by_disease(fact: DataFrame, dim_location: DataFrame, dim_disease: DataFrame) -> DataFrame:
    """C4: rank of each row's cases within its disease and the previous
    row's cases."""
    joined = _with_dims(
        fact,
        [
            (dim_location.select("location_id", "country"), "location_id"),
            (dim_disease.select("disease_id", "disease_name"), "disease_id"),
        ],
    )
    ranked = A.rank_and_lag(
        joined,
        ["disease_id"],
        "cases",
        tie_cols=["event_id"],
        rank_alias="rank_within_disease",
        lag_alias="prev_country_cases",
        probe=fact,
    )
    return ranked.select("country", "disease_name", "cases", "rank_within_disease", "prev_country_cases")


def top_disease_per_continent(fact: DataFrame, dim_location: DataFrame, dim_disease: DataFrame) -> DataFrame:
    """The disease with the most cases in each continent (NULL continent
    is its own group)."""
    joined = _with_dims(
        fact,
        [
            (dim_location.select("location_id", "continent"), "location_id"),
            (dim_disease.select("disease_id", "disease_name"), "disease_id"),
        ],
    )
    totals = A.sum_by(joined, ["continent", "disease_name"], {"total_cases": "cases", "total_deaths": "deaths"})
    top = A.top_n_per_group(
        totals,
        ["continent"],
        [F.col("total_cases").desc_nulls_first(), F.col("disease_name").asc_nulls_last()],
    )
    return A.order_desc(top, "total_cases", ["continent"])


def cases_in_continent(fact: DataFrame, dim_location: DataFrame, continent: str = "Asia") -> DataFrame:
    """Total cases per country of one continent."""
    joined = _with_dims(fact, [(dim_location.select("location_id", "country", "continent"), "location_id")])
    return A.filtered_sum(joined, F.col("continent") == F.lit(continent), ["country"], {"total_cases": "cases"})


def death_rate_above(fact: DataFrame, dim_location: DataFrame, min_pct: float = 1.0) -> DataFrame:
    """Countries whose death rate is above ``min_pct`` percent."""
    joined = _with_dims(fact, [(dim_location.select("location_id", "country"), "location_id")])
    return A.ratio_having(joined, ["country"], "deaths", "cases", min_pct)


def sessions(user_events: DataFrame, gap_minutes: float = 30.0) -> DataFrame:
    """Every event with its gap and session number, by user and time."""
    out = A.sessionize(user_events, ["user_id"], "event_time", gap_minutes)
    return out.orderBy(F.col("user_id").asc_nulls_last(), F.col("event_time").asc_nulls_last())


def upsert_location(dim_location: DataFrame, rows: DataFrame) -> DataFrame:
    """``INSERT ... ON CONFLICT (iso_code) DO UPDATE SET region, continent``."""
    return upsert(dim_location, rows, ["iso_code"], ["region", "continent"], "location_id")
