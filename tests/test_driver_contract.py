"""The driver contract: entry() runs, every query has a matching oracle, and
every query equals its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from quarry.plans import driver
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v.isoformat() if hasattr(v, "isoformat") else v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "death_rate_pct" in df.columns


def test_every_query_has_an_oracle():
    assert set(driver.queries()) == set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert _canon(df.columns, s_rows) == _canon(d_cols, d_rows)


def test_ordered_reports_keep_their_order(spark):
    q = E.queries()
    cases = [r.cases for r in q["star_report"](spark, SF_SMALL).collect()]
    assert cases == sorted(cases, reverse=True)
    keys = [(r.user_id, r.event_time) for r in q["sessionize"](spark, SF_SMALL).collect()]
    assert keys == sorted(keys)
    rates = [r.death_rate_pct for r in q["agg_having"](spark, SF_SMALL).collect()]
    assert rates == sorted(rates, reverse=True)
    totals = [r.total_cases for r in q["top_per_group"](spark, SF_SMALL).collect()]
    assert totals == sorted(totals, reverse=True)
