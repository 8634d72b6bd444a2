"""Duplicate readings: keep-first removal and duplicate counting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REPEATED_KEYS = 1_000_000  # that are sent to all tasks; more are joined by a shuffle


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row, in ``order``, of every key.

    Written as ``row_number() = 1`` because Spark then also prunes each map
    task's rows to one per key before the shuffle, so a key holding a large
    share of all rows reaches its reducer as one row per map task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(first)).where("__rank = 1").drop("__rank")


def part_ranks(df: DataFrame, group: str, seq: str = "_row_seq") -> DataFrame:
    """(group, part, rank): the files of each group in order of their names, from zero; one row per file."""
    parts = df.select(group, F.col(f"{seq}.part").alias("part")).distinct()
    return parts.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy("part")) - 1)


def file_position(seq: str = "_row_seq", rank: Column | None = None) -> Column:
    """Place of a row as one number of fixed width: rank of its file, byte offset of the split, row in scan."""
    row = F.col(f"{seq}.row").bitwiseAND(F.lit((1 << 33) - 1))  # above are the scan's partitions
    place = F.col(f"{seq}.block").cast("decimal(17,0)") * F.lit(1 << 33).cast("decimal(10,0)") + row.cast("decimal(10,0)")
    rank = F.lit(0) if rank is None else rank
    return (rank.cast("decimal(7,0)") * F.lit(f"{10**28}").cast("decimal(29,0)") + place).cast("decimal(38,0)")


def repeated_keys(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The keys that several rows share, with the smallest ``order`` among these as ``first``.

    ``order`` has a fixed width, so this is a hash aggregation that combines map-side: of a key,
    however many rows have it, one leaves each task, and no row's other columns move.
    """
    counted = df.groupBy(*keys).agg(F.min(order).alias("first"), F.count("*").alias("copies"))
    return counted.where("copies > 1").drop("copies")


def only_first(df: DataFrame, repeated: DataFrame, keys: list[str], order: Column, most: int = REPEATED_KEYS) -> DataFrame:
    """``df`` less all but the first row of each key in ``repeated``, a stored result of ``repeated_keys``.

    Rows of other keys pass; no row is shuffled or sorted unless more than ``most`` keys repeat.
    Then both sides are shuffled by key, and adaptive execution splits a hot one.
    """
    n = repeated.count()
    if n == 0:
        return df
    few = repeated.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("first").alias("__first"))
    few = F.broadcast(few) if n <= most else few.hint("shuffle_hash")
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    kept = df.join(few, same, "left").where(F.col("__first").isNull() | (F.col("__first") == order))
    return kept.select(*df.columns)


def duplicate_counts(df: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """Per ``group``: rows that share their key with another row, all copies counted.

    Two hash aggregations with fixed-width buffers; both combine map-side, so
    neither a hot key nor a hot group gathers raw rows in one task.  NULL keys
    compare equal.
    """
    copies = df.groupBy(group, *keys).agg(F.count("*").alias("__copies"))
    repeated = F.when(F.col("__copies") > 1, F.col("__copies")).otherwise(F.lit(0))
    return copies.groupBy(group).agg(F.sum(repeated).alias("duplicate_rows"))
