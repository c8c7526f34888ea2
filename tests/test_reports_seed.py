"""Golden results of the warehouse statements on the seed rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.plans import reports as R
from quarry.sources.inline import seed_tables, seed_user_events


@pytest.fixture(scope="module")
def star(spark):
    return seed_tables(spark)


def test_star_report_order_and_rates(star):
    rows = R.star_report(star["fact_health_events"], star["dim_date"], star["dim_location"], star["dim_disease"]).collect()
    got = [(str(r.event_date), r.country, r.continent, r.disease_name, r.cases, r.deaths, r.recovered, r.death_rate_pct) for r in rows]
    assert got == [
        ("2024-01-15", "United States", "Americas", "COVID-19", 45000, 380, 43000, 0.84),
        ("2024-01-15", "India", "Asia", "COVID-19", 15000, 120, 14200, 0.80),
        ("2024-12-01", "Brazil", "Americas", "Malaria", 12000, 95, 11500, 0.79),
        ("2024-03-20", "India", "Asia", "Dengue Fever", 8500, 45, 8100, 0.53),
        ("2024-09-05", "Germany", "Europe", "Tuberculosis", 4200, 62, 3900, 1.48),
        ("2024-06-10", "UAE", "Asia", "COVID-19", 2300, 18, 2200, 0.78),
    ]


def test_rank_and_lag(star):
    rows = R.rank_lag_by_disease(star["fact_health_events"], star["dim_location"], star["dim_disease"]).collect()
    got = {(r.country, r.disease_name): (r.cases, r.rank_within_disease, r.prev_country_cases) for r in rows}
    assert got[("United States", "COVID-19")] == (45000, 1, None)
    assert got[("India", "COVID-19")] == (15000, 2, 45000)
    assert got[("UAE", "COVID-19")] == (2300, 3, 15000)
    assert got[("India", "Dengue Fever")] == (8500, 1, None)
    assert got[("Germany", "Tuberculosis")] == (4200, 1, None)
    assert got[("Brazil", "Malaria")] == (12000, 1, None)


def test_top_disease_per_continent(star):
    rows = R.top_disease_per_continent(star["fact_health_events"], star["dim_location"], star["dim_disease"]).collect()
    assert [(r.continent, r.disease_name, r.total_cases, r.total_deaths) for r in rows] == [
        ("Americas", "COVID-19", 45000, 380),
        ("Asia", "COVID-19", 17300, 138),
        ("Europe", "Tuberculosis", 4200, 62),
    ]


def test_cases_in_asia(star):
    rows = R.cases_in_continent(star["fact_health_events"], star["dim_location"], "Asia").collect()
    assert sorted((r.country, r.total_cases) for r in rows) == [("India", 23500), ("UAE", 2300)]


def test_death_rate_above_one_percent(star):
    rows = R.death_rate_above(star["fact_health_events"], star["dim_location"], 1.0).collect()
    assert [(r.country, r.total_cases, r.total_deaths, r.death_rate_pct) for r in rows] == [("Germany", 4200, 62, 1.48)]


def test_null_continent_is_a_group(spark, star):
    # A loader-made location has no continent; it forms its own group
    loc = star["dim_location"].unionByName(
        spark.createDataFrame([(7, "Japan", None, None, "JPN")], star["dim_location"].schema)
    )
    fact = star["fact_health_events"].unionByName(
        star["fact_health_events"].where("event_id = 1").withColumn("event_id", F.lit(7).cast("bigint")).withColumn("location_id", F.lit(7).cast("bigint"))
    )
    rows = R.top_disease_per_continent(fact, loc, star["dim_disease"]).collect()
    assert (None, "COVID-19", 15000, 120) in [(r.continent, r.disease_name, r.total_cases, r.total_deaths) for r in rows]
    asia = R.cases_in_continent(fact, loc, "Asia").collect()
    assert "Japan" not in [r.country for r in asia]


def test_upsert_twice_is_idempotent(spark, star):
    japan = spark.createDataFrame([("Japan", "East Asia", "Asia", "JPN")], "country string, region string, continent string, iso_code string")
    once = R.upsert_location(star["dim_location"], japan)
    assert once.count() == 7
    jp = once.where("iso_code = 'JPN'").collect()[0]
    assert (jp.location_id, jp.country, jp.region, jp.continent) == (7, "Japan", "East Asia", "Asia")
    twice = R.upsert_location(once, japan)
    assert twice.count() == 7
    assert twice.where("iso_code = 'JPN'").collect()[0].location_id == 7


def test_sessions_on_reference_events(spark):
    rows = R.sessions(seed_user_events(spark)).collect()
    got = [(r.user_id, r.event_time, r.event_type, r.gap_minutes, r.session_id) for r in rows]
    t = dt.datetime
    assert got == [
        (1, t(2024, 1, 15, 9, 0), "page_view", None, 1),
        (1, t(2024, 1, 15, 9, 5), "click", 5.0, 1),
        (1, t(2024, 1, 15, 9, 8), "purchase", 3.0, 1),
        (1, t(2024, 1, 15, 10, 45), "page_view", 97.0, 2),
        (1, t(2024, 1, 15, 10, 50), "click", 5.0, 2),
        (2, t(2024, 1, 15, 14, 0), "page_view", None, 1),
        (2, t(2024, 1, 15, 14, 3), "click", 3.0, 1),
    ]


def test_reports_over_seeded_warehouse(spark):
    import uuid

    from quarry.plans.warehouse import Warehouse

    wh = Warehouse(spark, f"wh_{uuid.uuid4().hex[:8]}")
    wh.create()
    wh.seed(seed_tables(spark))
    rows = R.star_report(
        wh.table("fact_health_events"), wh.table("dim_date"), wh.table("dim_location"), wh.table("dim_disease")
    ).collect()
    assert [(r.country, r.cases, r.death_rate_pct) for r in rows][:2] == [("United States", 45000, 0.84), ("India", 15000, 0.80)]
    # the upsert result is published as the next version of the table
    japan = spark.createDataFrame([("Japan", "East Asia", "Asia", "JPN")], "country string, region string, continent string, iso_code string")
    wh.replace("dim_location", R.upsert_location(wh.table("dim_location"), japan))
    wh.replace("dim_location", R.upsert_location(wh.table("dim_location"), japan))
    assert wh.count("dim_location") == 7
