"""Bronze readings to silver: typing, time columns, null keys, keep-first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastline.constants import NATURAL_KEY
from mastline.functions import clock
from mastline.functions.numeric import as_double, as_long, text_to_double, text_to_long
from mastline.operators.dedup import file_position, keep_first, only_first, repeated_keys


# Text to declared type, for the columns that are not text.
DECLARED_CASTS = {
    "tower_id": text_to_long,
    "timestamp": text_to_long,
    "signal_strength": text_to_double,
    "data_volume_mb": text_to_double,
}


def type_readings(df: DataFrame, strict: bool = False) -> DataFrame:
    """Numeric columns to their declared types; unparsable values become NULL."""
    tower = as_long(df, "tower_id")
    if strict:
        number = as_double(df, "tower_id")
        complaint = F.concat(F.lit("non-integral tower_id: "), F.col("tower_id").cast("string"))
        tower = F.when(number.isNotNull() & tower.isNull(), F.raise_error(complaint)).otherwise(tower)
    return df.withColumns(
        {
            "tower_id": tower,
            "timestamp": as_long(df, "timestamp"),
            "signal_strength": as_double(df, "signal_strength"),
            "data_volume_mb": as_double(df, "data_volume_mb"),
        }
    )


def add_event_time(df: DataFrame) -> DataFrame:
    seconds = F.col("timestamp")
    return df.withColumns(
        {
            "event_datetime": clock.event_datetime(seconds),
            "event_date": clock.event_date(seconds),
            "event_hour": clock.event_hour(seconds),
        }
    )


# Wide-range numeric keys lead, so sort prefixes tell most rows apart.
_KEYS = ["timestamp", "tower_id", "region"]


def keyed_readings(df: DataFrame, strict: bool = False) -> DataFrame:
    """Typed readings whose key is complete.

    Nulls are dropped after coercion and before de-duplication, so a row that loses its key does
    not shadow a good one.
    """
    typed = type_readings(df, strict)
    for key in NATURAL_KEY:  # unlike dropna, these reach the Parquet scan
        typed = typed.where(F.col(key).isNotNull())
    return typed


def finished(df: DataFrame, run_id: str | None = None) -> DataFrame:
    """De-duplicated readings with their time columns, which are functions of the key."""
    clean = add_event_time(df)
    if run_id is not None:
        clean = clean.withColumn("_run_id", F.lit(run_id))
    return clean.drop("_row_seq")


def with_position(df: DataFrame, ranks: DataFrame | None, date_column: str = "_execution_date") -> DataFrame:
    """``df`` with the place of each row in its date; ``ranks`` (as of ``part_ranks``) where a date has several files."""
    if ranks is None:
        return df.withColumn("__position", file_position())
    ranks = F.broadcast(ranks.select(F.col(date_column).alias("__date"), F.col("part").alias("__part"), F.col("rank").alias("__rank")))
    same = (F.col(date_column) == F.col("__date")) & (F.col("_row_seq.part") == F.col("__part"))
    placed = df.join(ranks, same, "left").withColumn("__position", file_position(rank=F.col("__rank")))
    return placed.drop("__date", "__part", "__rank")


def repeats(df: DataFrame, date_column: str = "_execution_date") -> DataFrame:
    """The keys that several of the placed readings of a date share, and the place of the first."""
    return repeated_keys(df, [*_KEYS, date_column], F.col("__position"))


def without_repeats(df: DataFrame, repeated: DataFrame, date_column: str = "_execution_date") -> DataFrame:
    return only_first(df, repeated, [*_KEYS, date_column], F.col("__position")).drop("__position")


def clean_readings(
    df: DataFrame,
    run_id: str | None = None,
    order: list[str] | None = None,
    date_column: str = "_execution_date",
    strict: bool = False,
) -> DataFrame:
    """Clean any number of execution dates at once.

    ``order`` names the columns that give file order within a date; rows keep
    their own execution date and extra columns pass through.
    """
    if order is None:
        order = ["_row_seq.part", "_row_seq.block", "_row_seq.row"]
    return finished(keep_first(keyed_readings(df, strict), [*_KEYS, date_column], order), run_id)
