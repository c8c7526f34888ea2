"""Fixed schemas of the health warehouse (section 1.2 of the survey)."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw extract: the five projected CSV columns, all read as strings and parsed
# explicitly (never ``inferSchema``: that is a second pass over the data and
# turns junk into NULL instead of failing).
RAW_COLUMNS = ("iso_code", "location", "date", "new_cases", "new_deaths")
RAW = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Cleaned frame == staging table.
STAGING = T.StructType(
    [
        T.StructField("iso_code", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("event_date", T.TimestampNTZType(), True),
        T.StructField("cases", T.LongType(), True),
        T.StructField("deaths", T.LongType(), True),
        T.StructField("source_name", T.StringType(), True),
        T.StructField("loaded_at", T.TimestampNTZType(), True),
    ]
)
REQUIRED_COLUMNS = ("iso_code", "country", "event_date", "cases", "deaths")

DIM_DATE = T.StructType(
    [
        T.StructField("date_id", T.LongType(), False),
        T.StructField("full_date", T.DateType(), False),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("quarter", T.IntegerType(), True),
        T.StructField("month", T.IntegerType(), True),
        T.StructField("month_name", T.StringType(), True),
        T.StructField("week", T.IntegerType(), True),
        T.StructField("day_of_week", T.StringType(), True),
    ]
)

DIM_LOCATION = T.StructType(
    [
        T.StructField("location_id", T.LongType(), False),
        T.StructField("country", T.StringType(), False),
        T.StructField("region", T.StringType(), True),
        T.StructField("continent", T.StringType(), True),
        T.StructField("iso_code", T.StringType(), True),
    ]
)

DIM_DISEASE = T.StructType(
    [
        T.StructField("disease_id", T.LongType(), False),
        T.StructField("disease_name", T.StringType(), False),
        T.StructField("category", T.StringType(), True),
        T.StructField("icd_code", T.StringType(), True),
    ]
)

DIM_SOURCE = T.StructType(
    [
        T.StructField("source_id", T.LongType(), False),
        T.StructField("source_name", T.StringType(), False),
        T.StructField("source_url", T.StringType(), True),
        T.StructField("update_freq", T.StringType(), True),
    ]
)

FACT_HEALTH_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("date_id", T.LongType(), True),
        T.StructField("location_id", T.LongType(), True),
        T.StructField("disease_id", T.LongType(), True),
        T.StructField("source_id", T.LongType(), True),
        T.StructField("cases", T.IntegerType(), True),
        T.StructField("deaths", T.IntegerType(), True),
        T.StructField("recovered", T.IntegerType(), True),
        T.StructField("loaded_at", T.TimestampNTZType(), True),
    ]
)

USER_EVENTS = T.StructType(
    [
        T.StructField("user_id", T.IntegerType(), True),
        T.StructField("event_time", T.TimestampNTZType(), True),
        T.StructField("event_type", T.StringType(), True),
    ]
)

WAREHOUSE_TABLES = {
    "staging_health_events": STAGING,
    "dim_date": DIM_DATE,
    "dim_location": DIM_LOCATION,
    "dim_disease": DIM_DISEASE,
    "dim_source": DIM_SOURCE,
    "fact_health_events": FACT_HEALTH_EVENTS,
}

# Column types of the warehouse tables whose length the tables
# enforce on write (everything else has the type of its schema above).
COLUMN_TYPES = {
    "dim_date": {"month_name": "VARCHAR(20)", "day_of_week": "VARCHAR(20)"},
    "dim_location": {
        "country": "VARCHAR(100)",
        "region": "VARCHAR(100)",
        "continent": "VARCHAR(50)",
        "iso_code": "CHAR(3)",
    },
    "dim_disease": {"disease_name": "VARCHAR(200)", "category": "VARCHAR(100)", "icd_code": "VARCHAR(20)"},
    "dim_source": {"source_name": "VARCHAR(100)", "source_url": "VARCHAR(300)", "update_freq": "VARCHAR(50)"},
}

# NOT NULL columns, unique columns and references.
NOT_NULL = {name: [f.name for f in schema if not f.nullable] for name, schema in WAREHOUSE_TABLES.items()}
UNIQUE = {
    "dim_date": ["date_id", "full_date"],
    "dim_location": ["location_id", "iso_code"],
    "dim_disease": ["disease_id"],
    "dim_source": ["source_id"],
}
REFERENCES = {
    "date_id": "dim_date",
    "location_id": "dim_location",
    "disease_id": "dim_disease",
    "source_id": "dim_source",
}

# Natural key of a fact row (used by the "ignore" conflict mode).
FACT_NATURAL_KEY = ("date_id", "location_id", "disease_id", "source_id")
