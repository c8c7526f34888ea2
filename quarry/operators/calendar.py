"""Date dimension (P5, F-D1, F-D2): one row per distinct date with derived
calendar attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.dates import day_name, iso_week, month_name


def calendar_rows(df: DataFrame, date_col: str, pad_names: bool = False) -> DataFrame:
    """``SELECT DISTINCT d::DATE, year, quarter, month, month name, ISO week,
    day name FROM df WHERE d IS NOT NULL``.  The DISTINCT runs on the date
    alone (partial aggregation map-side); attributes are derived after it,
    on the few distinct dates.  ``pad_names=True`` blank-pads names to 9
    characters like ``TO_CHAR(d, 'Month'|'Day')``."""
    d = F.col("full_date")
    return (
        df.where(F.col(date_col).isNotNull())
        .select(F.to_date(F.col(date_col)).alias("full_date"))
        .distinct()
        .select(
            d,
            F.year(d).alias("year"),
            F.quarter(d).alias("quarter"),
            F.month(d).alias("month"),
            month_name(d, pad_names).alias("month_name"),
            iso_week(d).alias("week"),
            day_name(d, pad_names).alias("day_of_week"),
        )
    )
