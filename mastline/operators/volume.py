"""Received volume over time: how many rows a date brought, next to the last date that brought any."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Share of the previous volume below which a date counts as a drop, and above which as a surge.
DROP, SURGE = 0.5, 2.0


def row_counts(df: DataFrame, date: str = "_execution_date") -> DataFrame:
    """(execution_date, rows)."""
    return df.groupBy(F.col(date).alias("execution_date")).agg(F.count("*").alias("rows"))


def received_volume(counts: DataFrame, spine: DataFrame, drop: float = DROP, surge: float = SURGE) -> DataFrame:
    """(execution_date, rows, previous_rows, change, status) for every date of a gap-free spine.

    ``change`` is the share of the last earlier date with rows, NULL for the first and for dates
    without rows.  Status is ``missing``, ``first``, ``drop``, ``surge`` or ``steady``.  The window has
    one row per date.
    """
    per_date = spine.join(counts, "execution_date", "left").select("execution_date", F.coalesce("rows", F.lit(0)).alias("rows"))
    before = Window.orderBy("execution_date").rowsBetween(Window.unboundedPreceding, -1)
    previous = F.last(F.when(F.col("rows") > 0, F.col("rows")), ignorenulls=True).over(before)
    change = F.when(F.col("rows") > 0, F.col("rows") / F.col("previous_rows"))
    status = (
        F.when(F.col("rows") == 0, "missing")
        .when(F.col("previous_rows").isNull(), "first")
        .when(F.col("change") < drop, "drop")
        .when(F.col("change") > surge, "surge")
        .otherwise("steady")
    )
    return per_date.withColumn("previous_rows", previous).withColumn("change", change).withColumn("status", status)
