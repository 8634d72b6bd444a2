"""Folding ledger events into the current state of each run, table and date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mastline.constants import RUNNING, TRACKED_TABLES
from mastline.functions.clock import file_name_of

LEDGER_KEY = ["run_id", "table_name", "execution_date"]


def opening_events(spine: DataFrame, run_id: Column | str, seq: Column, at: Column) -> DataFrame:
    """One ``running`` event per date and tracked table."""
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    return spine.select(
        F.explode(F.array(*(F.lit(t) for t in TRACKED_TABLES))).alias("table_name"),
        "execution_date",
        file_name_of(F.col("execution_date")).alias("file_name"),
        seq.cast("bigint").alias("seq"),
        at.alias("event_at"),
        F.lit(RUNNING).alias("status"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(None).cast("bigint").alias("records_processed"),
        run.alias("run_id"),
    )


def _latest(name: str) -> Column:
    """Newest non-NULL value: an event without one keeps the older value."""
    return F.max_by(name, F.when(F.col(name).isNotNull(), F.col("seq")))


def current_state(events: DataFrame) -> DataFrame:
    """One row per run, table and date.

    Events of a key combine map-side, so a key with very many events stays
    cheap.  Opening a key again is harmless: it is running again.
    """
    is_open = F.col("status") == RUNNING
    folded = events.groupBy(*LEDGER_KEY).agg(
        _latest("file_name").alias("file_name"),
        F.max_by("event_at", F.when(is_open, F.col("seq"))).alias("start_datetime"),
        F.max_by("event_at", F.when(~is_open, F.col("seq"))).alias("closed_at"),
        F.max_by("status", "seq").alias("status"),
        _latest("error_message").alias("error_message"),
        _latest("records_processed").alias("records_processed"),
    )
    return folded.select(
        *LEDGER_KEY,
        "file_name",
        "start_datetime",
        F.when(F.col("status") != RUNNING, F.col("closed_at")).alias("finish_datetime"),
        "status",
        "error_message",
        "records_processed",
    )


def status_events(
    keys: DataFrame,
    status: str,
    seq: Column,
    at: Column,
    error: Column | None = None,
    records: Column | None = None,
) -> DataFrame:
    """The same status event for every key given."""
    none = F.lit(None)
    return keys.select(
        "table_name",
        "execution_date",
        none.cast("string").alias("file_name"),
        seq.cast("bigint").alias("seq"),
        at.alias("event_at"),
        F.lit(status).alias("status"),
        (none.cast("string") if error is None else error).alias("error_message"),
        (none if records is None else records).cast("bigint").alias("records_processed"),
        "run_id",
    )


def closing_events(
    state: DataFrame, status: str, seq: Column, at: Column, error: Column | None = None
) -> DataFrame:
    """Events that close every key still running; finished keys get none."""
    return status_events(state.where(F.col("status") == RUNNING), status, seq, at, error)


def folded_events(events: DataFrame) -> DataFrame:
    """Two events per key, or one while it is running, from which the same state follows as from all of them."""
    last = F.max("seq").over(Window.partitionBy(*LEDGER_KEY))
    state = current_state(events)
    newest = events.withColumn("last", last).where("seq = last").select(*LEDGER_KEY, F.col("last").alias("seq")).distinct()
    rows = state.join(newest, LEDGER_KEY)
    is_open = F.col("status") == RUNNING
    none = F.lit(None)

    def event(seq: Column, at: Column, status: Column) -> Column:
        return F.struct(seq.alias("seq"), at.alias("event_at"), status.alias("status"))

    opened = event(F.col("seq") - 1, F.col("start_datetime"), F.lit(RUNNING))
    closed = event(F.col("seq"), F.coalesce("finish_datetime", "start_datetime"), F.col("status"))
    both = F.when(is_open | F.col("start_datetime").isNull(), F.array(closed)).otherwise(F.array(opened, closed))
    return rows.withColumn("e", F.explode(both)).select(
        "table_name", "execution_date", "file_name", "e.seq", "e.event_at", "e.status",
        F.when(F.col("e.seq") == F.col("seq"), F.col("error_message")).otherwise(none).alias("error_message"),
        F.when(F.col("e.seq") == F.col("seq"), F.col("records_processed")).otherwise(none).alias("records_processed"),
        "run_id",
    )
