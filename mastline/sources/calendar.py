"""Run dates: inclusive ranges and which of them a run covers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def days_between(start: Column, end: Column) -> Column:
    """Array of ISO dates from start to end, both included; NULL if start is later."""
    first, last = F.to_date(start), F.to_date(end)
    # sequence() would count down from a later start.
    days = F.when(first <= last, F.sequence(first, last))
    return F.transform(days, lambda d: d.cast("string"))


def run_dates(logical: Column, start: Column, end: Column) -> Column:
    """Array of dates of a run: the range if both ends are given, else the logical date."""
    ranged = start.isNotNull() & end.isNotNull()
    return F.when(ranged, days_between(start, end)).otherwise(F.array(logical))


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per date of the range, ``execution_date`` as ISO text."""
    days = days_between(F.lit(start), F.lit(end))
    return spark.range(1).select(F.explode(days).alias("execution_date"))


def resolve_dates(
    spark: SparkSession, logical_date: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The dates of one run, one row each."""
    logical, first, last = (F.lit(d).cast("string") for d in (logical_date, start or None, end or None))
    return spark.range(1).select(F.explode(run_dates(logical, first, last)).alias("execution_date"))


def covered_range(df: DataFrame, date_column: str, margin: int = 0) -> DataFrame:
    """The spine from a table's first date to its last, ``margin`` days wider at both ends."""
    ends = df.agg(
        F.date_sub(F.to_date(F.min(date_column)), margin).cast("string").alias("first"),
        F.date_add(F.to_date(F.max(date_column)), margin).cast("string").alias("last"),
    )
    return ends.select(F.explode(days_between(F.col("first"), F.col("last"))).alias("execution_date"))
