"""Data-quality checks (V1-V12) and the pipeline gate.

A check is a *spec*: aggregate expressions it needs plus how to turn the
aggregated row into ``(passed, metric, threshold, message)``.  ``run_checks``
evaluates every spec's aggregates in **one** ``agg`` job (the reference makes
one pass per check); key-uniqueness specs add one ``groupBy`` job.  The result
is a small DataFrame ``check_name, passed, metric, threshold, message,
details`` (one row per check), so only a handful of scalars ever reach the
driver.  ``details`` is a map of strings: the counts behind a rate, missing
and present columns, the date range, and for a failed no-negatives check five
of the offending rows as JSON.

A check whose column is missing yields a failed row instead of raising."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.dates import now_plus_days
from quarry.functions.text import matches_code
from quarry.schemas import REQUIRED_COLUMNS

Result = tuple[Column, Column, float | None, Column]  # passed, metric, threshold, message

# Result messages (Java format strings; %,d groups thousands)
# and the status tags of a rendered line.
MSG_NOT_EMPTY = "DataFrame has %,d rows (minimum: %,d)"
MSG_ALL_COLUMNS = "All required columns present"
MSG_MISSING_COLUMNS = "Missing columns: {}"
MSG_NO_COLUMN = "Column '{}' does not exist"
MSG_NULL_RATE = "Null rate: %s (max allowed: %s)"
MSG_NO_NEGATIVES = "No negatives found"
MSG_NEGATIVES = "%,d negative values found"
MSG_DATES_OK = "Dates OK. Range: %s to %s"
MSG_FUTURE_DATES = "%,d future dates found"
MSG_CODES_OK = "All ISO codes valid"
MSG_BAD_CODES = "%,d invalid ISO codes found"
MSG_SOME_COLUMNS_MISSING = "Some columns not found: {}"
MSG_UNIQUE_OK = "Uniqueness OK: %,d duplicates (%s)"
MSG_DUPLICATES = "%,d duplicate rows (%s)"
MSG_COVERAGE = "%d countries found (minimum: %d)"
MSG_GATE_BAD_LENGTH = "%d rows have invalid iso_code"
MSG_GATE_NULL_RATE = "iso_code null rate is %s (max 1%%)"
MSG_GATE_FUTURE = "Future dates found in data"
PASS_TAG = "PASS ✓"
FAIL_TAG = "FAIL ✗"
LINE_FORMAT = "[%s] %s: %s"


@dataclass
class CheckSpec:
    name: str
    # alias -> aggregate Column, evaluated over the whole frame
    aggs: dict[str, Column] = field(default_factory=dict)
    # builds (passed, metric, threshold, message) from F.col(alias) refs
    result: Callable[[], Result] | None = None
    # uniqueness check: keys to group by (evaluated in its own job)
    group_keys: tuple[str, ...] | None = None
    # what stands behind the result, by name, from the same aggregates
    details: Callable[[], dict[str, Column]] = dict
    # a few offending rows, added to the details when the check fails
    sample: DataFrame | None = None


def _failed(name: str, message: str) -> CheckSpec:
    return CheckSpec(name, {}, lambda: (F.lit(False), F.lit(None), None, F.lit(message)))


def _is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))


def _pct(x: Column) -> Column:
    """Python's ``{:.1%}``."""
    return F.format_string("%.1f%%", x * F.lit(100.0))


# V1 ----------------------------------------------------------------------


def not_empty(df: DataFrame, min_rows: int = 100, name: str = "not_empty") -> CheckSpec:
    a = f"{name}__n"

    def result() -> Result:
        n = F.col(a)
        return (
            n >= F.lit(min_rows),
            n,
            float(min_rows),
            F.format_string(MSG_NOT_EMPTY, n, F.lit(min_rows)),
        )

    return CheckSpec(name, {a: F.count(F.lit(1))}, result, details=lambda: {"row_count": F.col(a)})


# V2 ----------------------------------------------------------------------


def required_columns(
    df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, name: str = "required_columns"
) -> CheckSpec:
    """Metadata only: no data is read."""
    missing = [c for c in required if c not in df.columns]
    msg = MSG_MISSING_COLUMNS.format(missing) if missing else MSG_ALL_COLUMNS
    return CheckSpec(
        name,
        {},
        lambda: (F.lit(not missing), F.lit(float(len(missing))), 0.0, F.lit(msg)),
        details=lambda: {"missing_columns": F.lit(",".join(missing)), "present_columns": F.lit(",".join(df.columns))},
    )


# V3 ----------------------------------------------------------------------


def null_rate(df: DataFrame, column: str, max_null_rate: float = 0.05, name: str | None = None) -> CheckSpec:
    """Share of NULLs (NaN counts as NULL in float columns) <= max (inclusive);
    an empty frame has rate 1.0."""
    name = name or f"null_rate_{column}"
    if column not in df.columns:
        return _failed(name, MSG_NO_COLUMN.format(column))
    c = F.col(column)
    is_null = (c.isNull() | F.isnan(c)) if _is_float(df, column) else c.isNull()
    an, ar = f"{name}__nulls", f"{name}__rows"

    def result() -> Result:
        rows = F.col(ar)
        rate = F.when(rows > 0, F.col(an) / rows).otherwise(F.lit(1.0))
        return (
            rate <= F.lit(max_null_rate),
            rate,
            float(max_null_rate),
            F.format_string(MSG_NULL_RATE, _pct(rate), _pct(F.lit(max_null_rate))),
        )

    def details() -> dict[str, Column]:
        return {"null_count": F.col(an), "row_count": F.col(ar), "null_rate": result()[1], "max_allowed": F.lit(max_null_rate)}

    return CheckSpec(name, {an: F.count_if(is_null), ar: F.count(F.lit(1))}, result, details=details)


# V4 / V5 -----------------------------------------------------------------


def no_negatives(df: DataFrame, column: str, name: str | None = None) -> CheckSpec:
    """No value < 0 (NULL is not negative)."""
    name = name or f"no_negatives_{column}"
    if column not in df.columns:
        return _failed(name, MSG_NO_COLUMN.format(column))
    a = f"{name}__neg"

    def result() -> Result:
        n = F.col(a)
        msg = F.when(n == 0, F.lit(MSG_NO_NEGATIVES)).otherwise(F.format_string(MSG_NEGATIVES, n))
        return n == 0, n, 0.0, msg

    return CheckSpec(
        name,
        {a: F.count_if(F.col(column) < F.lit(0))},
        result,
        details=lambda: {"negative_count": F.col(a)},
        sample=negative_sample(df, column, df.columns),
    )


def negative_sample(df: DataFrame, column: str, order_cols: Sequence[str], n: int = 5) -> DataFrame:
    """V5: up to ``n`` offending rows, first by ``order_cols`` (the limit is
    the feature: a sample for the report)."""
    return df.where(F.col(column) < F.lit(0)).orderBy(*order_cols).limit(n)


# V6 ----------------------------------------------------------------------


def date_range(
    df: DataFrame,
    date_column: str,
    now: dt.datetime,
    max_future_days: int = 1,
    name: str = "date_range",
) -> CheckSpec:
    """No date strictly after ``now + max_future_days``; NULL dates ignored.
    ``now`` is injected so results do not depend on the clock."""
    if date_column not in df.columns:
        return _failed(name, MSG_NO_COLUMN.format(date_column))
    d = F.to_timestamp_ntz(F.col(date_column)) if isinstance(
        df.schema[date_column].dataType, T.StringType
    ) else F.col(date_column).cast("timestamp_ntz")
    limit = now_plus_days(now, max_future_days)
    af, amin, amax = f"{name}__future", f"{name}__min", f"{name}__max"

    def result() -> Result:
        n = F.col(af)
        msg = F.when(
            n == 0,
            F.format_string(
                MSG_DATES_OK,
                F.to_date(F.col(amin)).cast("string"),
                F.to_date(F.col(amax)).cast("string"),
            ),
        ).otherwise(F.format_string(MSG_FUTURE_DATES, n))
        return n == 0, n, float(max_future_days), msg

    def details() -> dict[str, Column]:
        return {"min_date": F.to_date(F.col(amin)), "max_date": F.to_date(F.col(amax)), "future_count": F.col(af)}

    return CheckSpec(
        name, {af: F.count_if(d > limit), amin: F.min(d), amax: F.max(d)}, result, details=details
    )


# V8 ----------------------------------------------------------------------


def code_format(df: DataFrame, column: str = "iso_code", name: str = "iso_code_format") -> CheckSpec:
    """Every value is exactly three upper-case letters; NULL is invalid."""
    if column not in df.columns:
        return _failed(name, MSG_NO_COLUMN.format(column))
    a = f"{name}__bad"

    def result() -> Result:
        n = F.col(a)
        msg = F.when(n == 0, F.lit(MSG_CODES_OK)).otherwise(F.format_string(MSG_BAD_CODES, n))
        return n == 0, n, 0.0, msg

    return CheckSpec(name, {a: F.count_if(~matches_code(F.col(column)))}, result, details=lambda: {"invalid_count": F.col(a)})


# V9 ----------------------------------------------------------------------


def unique_combinations(
    df: DataFrame,
    columns: Sequence[str],
    max_duplicate_rate: float = 0.01,
    name: str = "unique_combinations",
) -> CheckSpec:
    """Rows beyond the first per key combination, as a share of all rows, <=
    max (inclusive); NULL equals NULL; an empty frame has rate 0."""
    if not all(c in df.columns for c in columns):
        return _failed(name, MSG_SOME_COLUMNS_MISSING.format(list(columns)))

    def result() -> Result:
        rows, dups = F.col("_q_rows"), F.col("_q_dups")
        rate = F.when(rows > 0, dups / rows).otherwise(F.lit(0.0))
        ok = rate <= F.lit(max_duplicate_rate)
        msg = F.when(ok, F.format_string(MSG_UNIQUE_OK, dups, _pct(rate))).otherwise(
            F.format_string(MSG_DUPLICATES, dups, _pct(rate))
        )
        return ok, rate, float(max_duplicate_rate), msg

    def details() -> dict[str, Column]:
        return {"duplicate_count": F.col("_q_dups"), "row_count": F.col("_q_rows"), "duplicate_rate": result()[1]}

    return CheckSpec(name, {}, result, group_keys=tuple(columns), details=details)


# V10 ---------------------------------------------------------------------


def coverage(
    df: DataFrame, column: str = "iso_code", min_distinct: int = 50, name: str = "country_coverage"
) -> CheckSpec:
    """At least ``min_distinct`` distinct non-NULL values (exact count)."""
    if column not in df.columns:
        return _failed(name, MSG_NO_COLUMN.format(column))
    a = f"{name}__distinct"

    def result() -> Result:
        n = F.col(a)
        return (
            n >= F.lit(min_distinct),
            n,
            float(min_distinct),
            F.format_string(MSG_COVERAGE, n, F.lit(min_distinct)),
        )

    return CheckSpec(
        name,
        {a: F.count_distinct(F.col(column))},
        result,
        details=lambda: {"country_count": F.col(a), "min_required": F.lit(min_distinct)},
    )


# runner ------------------------------------------------------------------

SAMPLE_KEY = "negative_rows"


def _result_struct(spec: CheckSpec, ordinal: int) -> Column:
    passed, metric, threshold, message = spec.result()
    return F.struct(
        F.lit(ordinal).alias("ordinal"),
        F.lit(spec.name).alias("check_name"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        metric.cast("double").alias("metric"),
        F.lit(threshold).cast("double").alias("threshold"),
        message.cast("string").alias("message"),
        _details(spec).alias("details"),
    )


def _details(spec: CheckSpec) -> Column:
    pairs = [(F.lit(k), v.cast("string")) for k, v in spec.details().items()]
    return F.create_map(*[x for pair in pairs for x in pair]).cast("map<string,string>")


def _samples(specs: Sequence[CheckSpec]) -> DataFrame | None:
    """``check_name, rows``: the sampled rows of each check that has some."""
    out: DataFrame | None = None
    for s in specs:
        if s.sample is not None:
            rows = s.sample.select(F.to_json(F.struct(*s.sample.columns)).alias("row"))
            one = rows.agg(F.array_join(F.array_sort(F.collect_list("row")), ",").alias("rows"))
            one = one.select(F.lit(s.name).alias("check_name"), F.concat(F.lit("["), "rows", F.lit("]")).alias("rows"))
            out = one if out is None else out.unionByName(one)
    return out


def run_checks(df: DataFrame, specs: Sequence[CheckSpec]) -> DataFrame:
    """Evaluate ``specs`` over ``df``: one aggregate job for all plain specs,
    one ``groupBy`` job per distinct key set of uniqueness specs.  Returns one
    row per spec, in spec order."""
    spark = df.sparkSession
    parts: list[DataFrame] = []
    plain = [(i, s) for i, s in enumerate(specs) if s.group_keys is None]
    aggs = {alias: expr for _, s in plain for alias, expr in s.aggs.items()}
    if plain:
        base = df.agg(*[e.alias(a) for a, e in aggs.items()]) if aggs else spark.range(1)
        parts.append(
            base.select(F.explode(F.array(*[_result_struct(s, i) for i, s in plain])).alias("r")).select("r.*")
        )
    by_keys: dict[tuple[str, ...], DataFrame] = {}
    for i, s in enumerate(specs):
        if s.group_keys is None:
            continue
        if s.group_keys not in by_keys:
            by_keys[s.group_keys] = (
                df.groupBy(*s.group_keys)
                .agg(F.count(F.lit(1)).alias("_q_n"))
                .agg(
                    F.coalesce(F.sum("_q_n"), F.lit(0)).alias("_q_rows"),
                    F.coalesce(F.sum(F.col("_q_n") - 1), F.lit(0)).alias("_q_dups"),
                )
            )
        parts.append(by_keys[s.group_keys].select(_result_struct(s, i).alias("r")).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    samples = _samples(specs)
    if samples is not None:
        out = out.join(samples.where("rows <> '[]'"), "check_name", "left")
        with_rows = F.map_concat("details", F.create_map(F.lit(SAMPLE_KEY), F.col("rows")))
        out = out.withColumn("details", F.when(F.col("rows").isNotNull(), with_rows).otherwise(F.col("details"))).drop("rows")
    return out.orderBy("ordinal").drop("ordinal")


# Checks over a history, batch by batch -----------------------------------

_MERGE = {"min": F.min, "max": F.max}  # any other aggregate is a count


def check_state(df: DataFrame, specs: Sequence[CheckSpec]) -> DataFrame:
    """The aggregates behind ``specs`` over one batch, as one row to keep with
    it.  Counts, minima and maxima can be merged; distinct counts and key
    uniqueness cannot and are refused (see ``quarry.operators.distinct``)."""
    refused = [s.name for s in specs if s.group_keys is not None or any(a.endswith("__distinct") for a in s.aggs)]
    if refused:
        raise ValueError(f"not mergeable: {refused}")
    aggs = {alias: expr for s in specs for alias, expr in s.aggs.items()}
    return df.agg(*[e.alias(a) for a, e in aggs.items()]) if aggs else df.sparkSession.range(1).select()


def merge_check_states(states: Sequence[DataFrame]) -> DataFrame:
    """One row for several batches, by the aggregates' names: ``__min`` and
    ``__max`` columns by theirs, all others are counts and add up."""
    rows = reduce(DataFrame.unionByName, states)
    return rows.agg(*[_MERGE.get(c.rsplit("__", 1)[-1], F.sum)(c).alias(c) for c in rows.columns])


def results_of_state(state: DataFrame, specs: Sequence[CheckSpec]) -> DataFrame:
    """The result rows of ``specs`` over all batches that ``state`` merges; no
    batch is read again, so a failed check has no sample rows."""
    results = F.explode(F.array(*[_result_struct(s, i) for i, s in enumerate(specs)]))
    return state.select(results.alias("r")).select("r.*").orderBy("ordinal").drop("ordinal")


def render(results: DataFrame) -> DataFrame:
    """V7: add ``line`` = ``[PASS ✓] name: message`` / ``[FAIL ✗] ...``."""
    tag = F.when(F.col("passed"), F.lit(PASS_TAG)).otherwise(F.lit(FAIL_TAG))
    return results.withColumn(
        "line", F.format_string(LINE_FORMAT, tag, F.col("check_name"), F.col("message"))
    )


def summarize(results: DataFrame) -> tuple[bool, list[Row]]:
    """Collect the (few) result rows: ``(all passed, rows)``."""
    rows = results.collect()
    return all(r["passed"] for r in rows), rows


# The validation suite -------------------------------------------------


def health_suite(df: DataFrame, now: dt.datetime) -> list[CheckSpec]:
    """The 11 checks of the validator, with its parameters, in its order."""
    # The suite's thresholds (min rows 100; NULL rates 0, 0 and
    # 10%; duplicate rate 1%; at least 50 countries; 1 day into the future).
    return [
        not_empty(df, min_rows=100),
        required_columns(df, REQUIRED_COLUMNS),
        null_rate(df, "iso_code", max_null_rate=0.00),
        null_rate(df, "event_date", max_null_rate=0.00),
        null_rate(df, "cases", max_null_rate=0.10),
        no_negatives(df, "cases"),
        no_negatives(df, "deaths"),
        date_range(df, "event_date", now, max_future_days=1),
        code_format(df, "iso_code"),
        unique_combinations(df, ["iso_code", "event_date"], max_duplicate_rate=0.01),
        coverage(df, "iso_code", min_distinct=50),
    ]


def validate(df: DataFrame, now: dt.datetime) -> tuple[bool, list[Row]]:
    """``validate_health_data``: run the suite, return (all passed, results)."""
    return summarize(run_checks(df, health_suite(df, now)))


# The pipeline gate -------------------------------------------------


def gate_specs(df: DataFrame, now: dt.datetime) -> list[CheckSpec]:
    """The six gate rules, with their exact quirks: only ``cases`` is tested
    for negatives; a NULL code counts as a wrong length; the code NULL rate
    fails only when strictly above 1% (an empty frame's rate is undefined and
    passes); the newest date must not be after ``now + 1 day``."""
    specs = [not_empty(df, min_rows=1, name="gate_not_empty"), required_columns(df, name="gate_required_columns")]
    if "cases" in df.columns:
        specs.append(no_negatives(df, "cases", name="gate_no_negative_cases"))
    else:
        specs.append(_failed("gate_no_negative_cases", MSG_NO_COLUMN.format("cases")))
    if "iso_code" in df.columns:
        bad_len = F.coalesce(F.length(F.col("iso_code")), F.lit(-1)) != F.lit(3)

        def length_result() -> Result:
            n = F.col("gate_iso_length__bad")
            msg = F.when(n == 0, F.lit("All codes have 3 characters")).otherwise(
                F.format_string(MSG_GATE_BAD_LENGTH, n)
            )
            return n == 0, n, 0.0, msg

        specs.append(CheckSpec("gate_iso_code_length", {"gate_iso_length__bad": F.count_if(bad_len)}, length_result))

        def null_result() -> Result:
            rows = F.col("gate_iso_null__rows")
            rate = F.col("gate_iso_null__nulls") / F.nullif(rows, F.lit(0))
            ok = ~F.coalesce(rate > F.lit(0.01), F.lit(False))
            msg = F.when(ok, F.lit("iso_code null rate within 1%")).otherwise(
                F.format_string(MSG_GATE_NULL_RATE, _pct(rate))
            )
            return ok, rate, 0.01, msg

        specs.append(
            CheckSpec(
                "gate_iso_code_null_rate",
                {
                    "gate_iso_null__nulls": F.count_if(F.col("iso_code").isNull()),
                    "gate_iso_null__rows": F.count(F.lit(1)),
                },
                null_result,
            )
        )
    else:
        specs.append(_failed("gate_iso_code_length", MSG_NO_COLUMN.format("iso_code")))
        specs.append(_failed("gate_iso_code_null_rate", MSG_NO_COLUMN.format("iso_code")))
    if "event_date" in df.columns:
        limit = now_plus_days(now, 1)

        def future_result() -> Result:
            mx = F.col("gate_future__max")
            bad = F.coalesce(mx > limit, F.lit(False))
            msg = F.when(bad, F.lit(MSG_GATE_FUTURE)).otherwise(F.lit("No future dates"))
            return ~bad, F.when(bad, F.lit(1.0)).otherwise(F.lit(0.0)), 1.0, msg

        specs.append(
            CheckSpec(
                "gate_future_dates",
                {"gate_future__max": F.max(F.col("event_date").cast("timestamp_ntz"))},
                future_result,
            )
        )
    else:
        specs.append(_failed("gate_future_dates", MSG_NO_COLUMN.format("event_date")))
    return specs


def profile_specs(df: DataFrame) -> dict[str, Column]:
    """Run profile aggregates (rows, countries, date range)."""
    return {
        "rows": F.count(F.lit(1)),
        "countries": F.count_distinct(F.col("iso_code")),
        "min_date": F.min(F.to_date(F.col("event_date"))),
        "max_date": F.max(F.to_date(F.col("event_date"))),
    }


def gate(df: DataFrame, now: dt.datetime) -> tuple[bool, list[Row]]:
    """``run_quality_checks``: (passed, rule rows)."""
    return summarize(run_checks(df, gate_specs(df, now)))


class QualityGateError(RuntimeError):
    """The gate failed: the batch was written as an unpublished version and
    dropped again, so no reader ever saw it (G2)."""


# Constraint checks ----------------------------------------------------


def constraint_checks(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[Sequence[str]] = (),
    foreign_keys: Sequence[tuple[str, DataFrame, str]] = (),
    prefix: str = "",
) -> DataFrame:
    """Re-aim of NOT NULL, UNIQUE and REFERENCES, which Parquet tables do not
    enforce: one row ``(check_name, violations)`` per constraint.

    - NOT NULL: rows with NULL (all columns in one aggregate job)
    - UNIQUE: non-NULL keys occurring more than once (NULLs never conflict)
    - FK: non-NULL values with no row in the referenced table (anti join)"""
    spark = df.sparkSession
    parts: list[DataFrame] = []
    if not_null:
        row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        parts.append(
            row.select(
                F.explode(
                    F.array(
                        *[
                            F.struct(
                                F.lit(f"{prefix}not_null_{c}").alias("check_name"),
                                F.col(c).cast("bigint").alias("violations"),
                            )
                            for c in not_null
                        ]
                    )
                ).alias("r")
            ).select("r.*")
        )
    for keys in unique:
        keys = list(keys)
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).isNotNull()
        dup = (
            df.where(cond)
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_q_n"))
            .agg(F.count_if(F.col("_q_n") > 1).cast("bigint").alias("violations"))
        )
        parts.append(dup.select(F.lit(f"{prefix}unique_{'_'.join(keys)}").alias("check_name"), "violations"))
    for fk, ref, pk in foreign_keys:
        orphans = (
            df.where(F.col(fk).isNotNull())
            .select(F.col(fk).alias("_q_k"))
            .join(ref.select(F.col(pk).alias("_q_k")).distinct(), "_q_k", "left_anti")
            .agg(F.count(F.lit(1)).cast("bigint").alias("violations"))
        )
        parts.append(orphans.select(F.lit(f"{prefix}fk_{fk}").alias("check_name"), "violations"))
    if not parts:
        return spark.createDataFrame([], "check_name string, violations bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
