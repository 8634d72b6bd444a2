"""Event tables seen as readings, clean or with faults put in by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastline.constants import REQUIRED_COLUMNS
from mastline.functions import clock


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """The ``events`` table as typed readings with a row order ``seq``."""
    seconds = clock.seconds_of(F.col("ts"))
    return spark.read.parquet(f"{folder}/events.parquet").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("tower_id"),
        F.col("event_type").alias("region"),
        seconds.alias("timestamp"),
        (F.lit(-120.0) + F.col("value")).alias("signal_strength"),
        F.col("value").alias("data_volume_mb"),
        clock.event_date(seconds).alias("_execution_date"),
    )


def faulty_readings(spark: SparkSession, folder: str, bad_tower: str | None = "bad") -> DataFrame:
    """All reading columns as text, with duplicates, gaps and bad values.

    Faults follow from the event id, so any engine can build the same rows.
    A repeated row carries a later ``seq`` and another volume.  With
    ``bad_tower`` None the unreadable tower ids are blank instead.
    """
    e = F.col("seq")

    def every(n: int):
        return e % n == 0

    text = readings(spark, folder).withColumn(
        "copy", F.explode(F.when(every(10), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    )
    volume = F.col("data_volume_mb") + F.col("copy")
    return text.select(
        (e + F.col("copy") * 1_000_000_000).alias("seq"),
        F.when(every(19), F.lit(bad_tower)).otherwise(F.col("tower_id").cast("string")).alias("tower_id"),
        F.when(~every(17), F.col("region")).alias("region"),
        F.when(
            ~every(37),
            (F.col("timestamp") + F.when(every(31), clock.DAY_SECONDS).otherwise(0)).cast("string"),
        ).alias("timestamp"),
        F.when(every(23), F.lit("n/a")).otherwise(F.col("signal_strength").cast("string")).alias("signal_strength"),
        F.when(every(29), -volume).otherwise(volume).cast("string").alias("data_volume_mb"),
        "_execution_date",
    )


def text_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Clean readings as text, signals within their range."""
    signal = F.least("signal_strength", F.lit(-40.5))
    clean = readings(spark, folder).withColumn("signal_strength", signal)
    return clean.withColumns({c: F.col(c).cast("string") for c in REQUIRED_COLUMNS})


def write_drops(df: DataFrame, folder: str, more: tuple[str, ...] = ()) -> None:
    """Write readings as one daily source per date, rows in ``seq`` order, columns ``more`` first.

    Ranges over (date, seq) keep the order across part files without putting a
    whole date into one task.
    """
    named = df.withColumn("drop", clock.file_name_of(F.col("_execution_date")))
    (
        named.repartitionByRange("drop", "seq")
        .sortWithinPartitions("drop", "seq")
        .select("drop", *more, *REQUIRED_COLUMNS)
        .write.mode("append")
        .partitionBy("drop")
        .csv(folder, header=True, escape='"')
    )
