"""Inline sources: seed rows of the warehouse (S6) and generated frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas as S

# The warehouse seed rows (ids in insertion order).
SEED_DIM_LOCATION = [
    (1, "India", "South Asia", "Asia", "IND"),
    (2, "United States", "North America", "Americas", "USA"),
    (3, "Germany", "Western Europe", "Europe", "DEU"),
    (4, "UAE", "Middle East", "Asia", "ARE"),
    (5, "Brazil", "South America", "Americas", "BRA"),
    (6, "China", "East Asia", "Asia", "CHN"),
]
SEED_DIM_DATE = [
    (1, dt.date(2024, 1, 15), 2024, 1, 1, "January", 3, "Monday"),
    (2, dt.date(2024, 3, 20), 2024, 1, 3, "March", 12, "Wednesday"),
    (3, dt.date(2024, 6, 10), 2024, 2, 6, "June", 24, "Monday"),
    (4, dt.date(2024, 9, 5), 2024, 3, 9, "September", 36, "Thursday"),
    (5, dt.date(2024, 12, 1), 2024, 4, 12, "December", 49, "Sunday"),
]
SEED_DIM_DISEASE = [
    (1, "COVID-19", "Infectious", "U07.1"),
    (2, "Dengue Fever", "Infectious", "A90"),
    (3, "Tuberculosis", "Infectious", "A15"),
    (4, "Diabetes Type 2", "Chronic", "E11"),
    (5, "Malaria", "Infectious", "B50"),
]
SEED_DIM_SOURCE = [
    (1, "WHO", "https://www.who.int/data", "Daily"),
    (2, "World Bank", "https://data.worldbank.org", "Monthly"),
    (3, "NASA", "https://data.nasa.gov", "Daily"),
    (4, "Our World in Data", "https://ourworldindata.org", "Weekly"),
]
# (event_id, date_id, location_id, disease_id, source_id, cases, deaths, recovered)
SEED_FACTS = [
    (1, 1, 1, 1, 1, 15000, 120, 14200),
    (2, 1, 2, 1, 1, 45000, 380, 43000),
    (3, 2, 1, 2, 1, 8500, 45, 8100),
    (4, 3, 4, 1, 1, 2300, 18, 2200),
    (5, 4, 3, 3, 1, 4200, 62, 3900),
    (6, 5, 5, 5, 1, 12000, 95, 11500),
]
# (user_id, event_time, event_type)
SEED_USER_EVENTS = [
    (1, "2024-01-15 09:00:00", "page_view"),
    (1, "2024-01-15 09:05:00", "click"),
    (1, "2024-01-15 09:08:00", "purchase"),
    (1, "2024-01-15 10:45:00", "page_view"),
    (1, "2024-01-15 10:50:00", "click"),
    (2, "2024-01-15 14:00:00", "page_view"),
    (2, "2024-01-15 14:03:00", "click"),
]


def reference_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The seed rows of the dimensions that no load creates: every fact must
    name a disease and a source that exist."""
    seeds = seed_tables(spark)
    return {name: seeds[name] for name in ("dim_disease", "dim_source")}


def seed_tables(spark: SparkSession, loaded_at: dt.datetime | None = None) -> dict[str, DataFrame]:
    """The seed rows as DataFrames with the warehouse schemas."""
    loaded_at = loaded_at or dt.datetime(2024, 1, 1)
    facts = [(*r, loaded_at) for r in SEED_FACTS]
    return {
        "dim_location": spark.createDataFrame(SEED_DIM_LOCATION, S.DIM_LOCATION),
        "dim_date": spark.createDataFrame(SEED_DIM_DATE, S.DIM_DATE),
        "dim_disease": spark.createDataFrame(SEED_DIM_DISEASE, S.DIM_DISEASE),
        "dim_source": spark.createDataFrame(SEED_DIM_SOURCE, S.DIM_SOURCE),
        "fact_health_events": spark.createDataFrame(facts, S.FACT_HEALTH_EVENTS),
    }


def seed_user_events(spark: SparkSession) -> DataFrame:
    rows = [(u, dt.datetime.fromisoformat(t), e) for u, t, e in SEED_USER_EVENTS]
    return spark.createDataFrame(rows, S.USER_EVENTS)


def daily_dates(spark: SparkSession, start: dt.date, periods: int, name: str = "event_date") -> DataFrame:
    """``pd.date_range(start, periods=n, freq='D')`` as a distributed frame:
    ``spark.range`` splits the ids over tasks, each adds its days."""
    return spark.range(periods).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).cast("timestamp_ntz").alias(name)
    )
