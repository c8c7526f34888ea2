"""Command line entry points.

    python -m quarry.cli load CSV... [--database NAME] [--on-conflict append|ignore]
    python -m quarry.cli validate CSV... [--now YYYY-MM-DD]
    python -m quarry.cli seed [--database NAME]
    python -m quarry.cli report {star,rank,top,continent,rate,sessions} [--database NAME]

``load`` runs the whole ELT (G2: exit code 1 when the quality gate fails,
before anything is published); ``validate`` cleans the extract and prints
the 11-check suite, one rendered line per check; ``seed`` creates the tables
and loads the seed rows; ``report`` prints one of the warehouse statements.
All use the session the environment provides (``spark-submit`` settings or
defaults)."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from quarry.operators import quality as Q
from quarry.operators.clean import clean_events
from quarry.plans import reports as R
from quarry.plans.elt import run_elt
from quarry.plans.warehouse import Warehouse
from quarry.sources.csv import read_csv_projected
from quarry.sources.inline import seed_tables, seed_user_events


def _session() -> SparkSession:
    return SparkSession.builder.appName("quarry").getOrCreate()


def _load(args: argparse.Namespace) -> int:
    spark = _session()
    try:
        res = run_elt(spark, args.csv, Warehouse(spark, args.database), on_conflict=args.on_conflict)
    except Q.QualityGateError as exc:
        print(f"ABORTED: {exc}", file=sys.stderr)
        return 1
    print(f"extracted {res.stage_rows.get('extract', 0):,} rows; staged {res.rows_staged:,}")
    print(f"countries {res.countries}; dates {res.min_date} to {res.max_date}")
    print(f"new locations {res.new_locations}; new dates {res.new_dates}")
    print(f"facts appended {res.facts_appended:,}; fact rows {res.fact_rows_total:,}")
    print(f"staging rows without a dimension match: {res.staging_unmatched:,}")
    print(f"seconds: {res.timings}")
    return 0


def _validate(args: argparse.Namespace) -> int:
    spark = _session()
    now = dt.datetime.fromisoformat(args.now) if args.now else dt.datetime.now().replace(microsecond=0)
    clean = clean_events(read_csv_projected(spark, args.csv), now)
    results = Q.render(Q.run_checks(clean, Q.health_suite(clean, now)))
    rows = results.collect()
    for r in rows:
        print(r["line"])
    failed = sum(1 for r in rows if not r["passed"])
    print(f"{len(rows) - failed} passed, {failed} failed")
    return 0 if failed == 0 else 1


def _seed(args: argparse.Namespace) -> int:
    spark = _session()
    wh = Warehouse(spark, args.database)
    wh.create()
    wh.seed(seed_tables(spark))
    print(f"seeded {args.database}")
    return 0


def _report(args: argparse.Namespace) -> int:
    spark = _session()
    wh = Warehouse(spark, args.database)
    t = wh.table
    reports = {
        "star": lambda: R.star_report(t("fact_health_events"), t("dim_date"), t("dim_location"), t("dim_disease")),
        "rank": lambda: R.rank_lag_by_disease(t("fact_health_events"), t("dim_location"), t("dim_disease")),
        "top": lambda: R.top_disease_per_continent(t("fact_health_events"), t("dim_location"), t("dim_disease")),
        "continent": lambda: R.cases_in_continent(t("fact_health_events"), t("dim_location"), args.continent),
        "rate": lambda: R.death_rate_above(t("fact_health_events"), t("dim_location"), args.min_pct),
        "sessions": lambda: R.sessions(seed_user_events(spark), args.gap_minutes),
    }
    report = reports[args.name]()
    if args.output:
        # every row, as CSV part files written by the tasks
        report.write.option("header", True).mode("errorifexists").csv(args.output)
        print(f"written to {args.output}")
    else:
        report.show(args.rows, truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quarry")
    sub = parser.add_subparsers(dest="command", required=True)
    load = sub.add_parser("load", help="extract, clean, gate and load into the warehouse")
    load.add_argument("csv", nargs="+")
    load.add_argument("--database", default="health_wh")
    load.add_argument("--on-conflict", choices=["append", "ignore"], default="append")
    load.set_defaults(func=_load)
    val = sub.add_parser("validate", help="run the validation suite on a cleaned extract")
    val.add_argument("csv", nargs="+")
    val.add_argument("--now", help="clock for the date-range check (default: now)")
    val.set_defaults(func=_validate)
    seed = sub.add_parser("seed", help="create the warehouse tables and load the seed rows")
    seed.add_argument("--database", default="health_wh")
    seed.set_defaults(func=_seed)
    rep = sub.add_parser("report", help="print a warehouse report")
    rep.add_argument("name", choices=["star", "rank", "top", "continent", "rate", "sessions"])
    rep.add_argument("--database", default="health_wh")
    rep.add_argument("--continent", default="Asia")
    rep.add_argument("--min-pct", type=float, default=1.0)
    rep.add_argument("--gap-minutes", type=float, default=30.0)
    rep.add_argument("--rows", type=int, default=20, help="rows to print (a preview)")
    rep.add_argument("--output", help="folder to write the whole report to, as CSV")
    rep.set_defaults(func=_report)
    args = parser.parse_args(argv)
    return args.func(args)


if __name__ == "__main__":
    raise SystemExit(main())
