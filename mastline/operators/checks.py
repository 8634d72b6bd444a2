"""Data-quality checks over any number of dates in one job.

Every check yields ``execution_date, check_name, status, message, failed_rows``.
Rows are reduced to per-date counters first; the verdicts and their texts are
then worked out on one row per date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mastline.constants import (
    NATURAL_KEY,
    REQUIRED_COLUMNS,
    SIGNAL_MAX,
    SIGNAL_MIN,
    VOLUME_MIN,
)
from mastline.functions import clock
from mastline.functions.messages import name_list, name_set
from mastline.functions.numeric import as_double, as_long
from mastline.operators import kinds
from mastline.operators.dedup import duplicate_counts

ALL_CHECKS = [
    "not_empty",
    "schema_columns",
    "null_check",
    "signal_range",
    "data_volume_positive",
    "timestamp_freshness",
    "duplicate_rows",
]

EVOLUTION = "schema_evolution"  # the check that comes last where it is asked for

_BAND = f"[{SIGNAL_MIN}, {SIGNAL_MAX}] dBm"


class QualityError(ValueError):
    """At least one date failed a hard check; the log has been written."""


def out_of_range(signal: Column) -> Column:
    return (signal < SIGNAL_MIN) | (signal > SIGNAL_MAX)


def outside_day(seconds: Column, date: Column, tz: str = "UTC") -> Column:
    first, last = clock.day_bounds(date, tz)
    return (seconds < first) | (seconds > last)


def counters(
    df: DataFrame, checks: list[str] = ALL_CHECKS, date: str = "_execution_date", tz: str = "UTC", evolution: bool = False
) -> DataFrame:
    """One row per date with the counters the checks need; one pass, map-side combined."""
    have = set(df.columns)
    wanted = [F.count("*").alias("n_rows")]
    if "null_check" in checks:
        wanted += [
            F.count_if(_absent(df, c)).alias(f"null_{c}") for c in REQUIRED_COLUMNS if c in have
        ]
    if "signal_range" in checks and "signal_strength" in have:
        wanted.append(F.count_if(out_of_range(as_double(df, "signal_strength"))).alias("bad_signal"))
    if "data_volume_positive" in checks and "data_volume_mb" in have:
        wanted.append(F.count_if(as_double(df, "data_volume_mb") < VOLUME_MIN).alias("bad_volume"))
    if "timestamp_freshness" in checks and "timestamp" in have:
        outside = outside_day(as_long(df, "timestamp"), F.col(date), tz)
        wanted.append(F.count_if(outside).alias("bad_time"))
    if evolution:
        wanted.append(kinds.kind_counts(df).alias("kinds"))
    return df.groupBy(F.col(date).alias("execution_date")).agg(*wanted)


def _absent(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if df.schema[name].dataType.typeName() in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def run_checks(
    df: DataFrame,
    columns_by_date: DataFrame | None = None,
    checks: list[str] = ALL_CHECKS,
    date: str = "_execution_date",
    tz: str = "UTC",
    include_evolution: bool = False,
    strict: bool = False,
) -> DataFrame:
    """The requested checks, in their fixed order, for every date.

    ``include_evolution`` adds the schema-change verdict as one more check, judged as
    ``strict`` says; its counters come by the same pass as the others'.

    ``columns_by_date`` (``execution_date, columns``) names the dates to report,
    including dates without a single row, and the columns each date's source
    had.  Without it the dates present in ``df`` are reported with ``df``'s columns.
    """
    per_date = counters(df, checks, date, tz, include_evolution)
    if "duplicate_rows" in checks:
        keys = [c for c in NATURAL_KEY if c in df.columns]
        if keys:
            # Only date and key columns reach this second, wider aggregation.
            repeats = duplicate_counts(df.select(F.col(date).alias("execution_date"), *keys), "execution_date", keys)
            per_date = per_date.join(repeats, "execution_date", "left")
    if columns_by_date is not None:
        per_date = columns_by_date.select("execution_date", "columns").join(per_date, "execution_date", "left")
    else:
        visible = [c for c in df.columns if c != "_row_seq"]
        per_date = per_date.withColumn("columns", F.array(*(F.lit(c) for c in visible)))

    present = set(per_date.columns)
    ordered = [_VERDICTS[c](present) for c in ALL_CHECKS if c in checks]
    if include_evolution:
        ordered.append(_verdict(EVOLUTION, *kinds.evolution_verdict(strict)))
    return per_date.select("execution_date", F.inline(F.array(*ordered)))


# -- verdicts, each a struct on one row per date ---------------------------


def _verdict(name: str, status: Column, message: Column, failed: Column | None = None) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        status.alias("status"),
        message.alias("message"),
        (F.lit(0) if failed is None else F.coalesce(failed, F.lit(0))).cast("bigint").alias("failed_rows"),
    )


def _count(present: set[str], name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)) if name in present else F.lit(0)


def _has(column: str) -> Column:
    return F.array_contains("columns", column)


def _required() -> Column:
    return F.array(*(F.lit(c) for c in REQUIRED_COLUMNS))


def _metric(name: str, column: str, bad: Column, clean: Column, found: Column) -> Column:
    """Warn when ``bad`` rows exist, or when the column itself is missing."""
    return _verdict(
        name,
        F.when(~_has(column) | (bad > 0), "warn").otherwise("pass"),
        F.when(~_has(column), f"Column {column} missing, skipped.")
        .when(bad > 0, F.concat(bad.cast("string"), found))
        .otherwise(clean),
        F.when(_has(column), bad),
    )


def _not_empty(present: set[str]) -> Column:
    n = _count(present, "n_rows")
    return _verdict(
        "not_empty",
        F.when(n == 0, "fail").otherwise("pass"),
        F.when(n == 0, "File contains zero rows.").otherwise(F.concat(n.cast("string"), F.lit(" rows found."))),
    )


def _schema_columns(present: set[str]) -> Column:
    lacking = F.array_except(_required(), "columns")
    extra = F.array_except("columns", _required())
    complete = F.lit("All required columns present.")
    return _verdict(
        "schema_columns",
        F.when(F.size(lacking) > 0, "fail").otherwise("pass"),
        F.when(F.size(lacking) > 0, F.concat(F.lit("Missing columns: "), name_set(lacking)))
        .when(F.size(extra) > 0, F.concat(complete, F.lit(" Extra columns (ignored): "), name_set(extra)))
        .otherwise(complete),
    )


def _null_check(present: set[str]) -> Column:
    # A column its source lacks is NULL throughout here, which is not a gap.
    gaps = {c: F.when(_has(c), _count(present, f"null_{c}")).otherwise(F.lit(0)) for c in REQUIRED_COLUMNS}
    total = sum(gaps.values(), F.lit(0))
    parts = [F.when(n > 0, F.concat(F.lit(f"{c}="), n.cast("string"))) for c, n in gaps.items()]
    return _verdict(
        "null_check",
        F.when(total > 0, "warn").otherwise("pass"),
        F.when(total > 0, F.concat(F.lit("Nulls found — "), F.concat_ws(", ", *parts))).otherwise(
            "No nulls in required columns."
        ),
        total,
    )


def _signal_range(present: set[str]) -> Column:
    return _metric(
        "signal_range",
        "signal_strength",
        _count(present, "bad_signal"),
        F.lit(f"All values in {_BAND}."),
        F.lit(f" rows outside expected range {_BAND}."),
    )


def _data_volume_positive(present: set[str]) -> Column:
    return _metric(
        "data_volume_positive",
        "data_volume_mb",
        _count(present, "bad_volume"),
        F.lit("All data_volume_mb values ≥ 0."),
        F.lit(" rows with negative data_volume_mb."),
    )


def _timestamp_freshness(present: set[str]) -> Column:
    date = F.col("execution_date")
    usual = _metric(
        "timestamp_freshness",
        "timestamp",
        _count(present, "bad_time"),
        F.concat(F.lit("All timestamps within "), date, F.lit(".")),
        F.concat(F.lit(" rows have timestamps outside "), date, F.lit(".")),
    )
    undated = _verdict(
        "timestamp_freshness",
        F.lit("warn"),
        F.concat(
            F.lit("Could not validate freshness: time data '"),
            date,
            F.lit("' does not match format '%Y-%m-%d'"),
        ),
    )
    readable = F.try_to_date(date, "yyyy-MM-dd").isNotNull()
    return F.when(_has("timestamp") & ~readable, undated).otherwise(usual)


def _duplicate_rows(present: set[str]) -> Column:
    keys = F.array_intersect(F.array(*(F.lit(c) for c in NATURAL_KEY)), "columns")
    keyed = F.size(keys) > 0
    n = _count(present, "duplicate_rows")
    return _verdict(
        "duplicate_rows",
        F.when(~keyed | (n > 0), "warn").otherwise("pass"),
        F.when(~keyed, "Key columns missing, skipped.")
        .when(n > 0, F.concat(n.cast("string"), F.lit(" duplicate rows on "), name_list(keys), F.lit(".")))
        .otherwise("No duplicate rows."),
        F.when(keyed, n),
    )


_VERDICTS = {
    "not_empty": _not_empty,
    "schema_columns": _schema_columns,
    "null_check": _null_check,
    "signal_range": _signal_range,
    "data_volume_positive": _data_volume_positive,
    "timestamp_freshness": _timestamp_freshness,
    "duplicate_rows": _duplicate_rows,
}


# -- digests ---------------------------------------------------------------


def has_failures() -> Column:
    """Aggregate over results: whether any check failed."""
    return F.coalesce(F.bool_or(F.col("status") == "fail"), F.lit(False))


def any_failure(results: DataFrame) -> bool:
    return results.agg(has_failures().alias("failed")).first().failed


def gate_digest(results: DataFrame) -> DataFrame:
    """Per date: whether it failed, and its failing and warning checks as text."""
    place = F.array_position(F.array(*(F.lit(c) for c in [*ALL_CHECKS, EVOLUTION])), F.col("check_name"))

    def named(status: str) -> Column:
        # At most one entry per check.
        hits = F.collect_list(F.when(F.col("status") == status, F.struct(place.alias("place"), "check_name")))
        return name_list(F.transform(F.array_sort(hits), lambda h: h["check_name"]))

    return results.groupBy("execution_date").agg(
        has_failures().alias("has_failures"),
        named("fail").alias("failed_checks"),
        named("warn").alias("warned_checks"),
    )


def require_quality(results: DataFrame) -> None:
    """Raise if any date has a hard failure; one row per failing date is collected."""
    failed = gate_digest(results).where("has_failures").orderBy("execution_date").collect()
    if failed:
        listed = [f"{r.execution_date}: {r.failed_checks}" for r in failed]
        raise QualityError(f"DQ hard failures: {listed}")
