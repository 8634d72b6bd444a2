"""The run ledger: an append-only event table, one partition per run."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastline.constants import RUNNING
from mastline.functions.clock import utc_now
from mastline.operators import ledger as fold
from mastline.schemas import LEDGER_EVENT_SCHEMA
from mastline.session import small_frame
from mastline.sinks.tables import DatedTable


class RunLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = DatedTable(spark, path, "run_id", LEDGER_EVENT_SCHEMA)
        self._last_seq = 0

    def _tick(self) -> tuple:
        """Sequence number and time text of the next batch of events."""
        self._last_seq = max(time.time_ns(), self._last_seq + 1)
        return F.lit(self._last_seq), F.lit(utc_now())

    def state(self, run_id: str | None = None) -> DataFrame:
        """Current row of every key, of one run or of all."""
        return fold.current_state(self.table.read({"run_id": run_id} if run_id else None))

    def open(self, run_id: str, spine: DataFrame) -> None:
        """Mark every tracked table as running for every date of the spine."""
        self.table.append(fold.opening_events(spine, run_id, *self._tick()))

    def insert_run(
        self, run_id: str, table_name: str, execution_date: str, file: str | None = None
    ) -> None:
        """Open one key."""
        self._record(run_id, [(table_name, execution_date, RUNNING, None, None)], file)

    def record(self, run_id: str, rows: list[tuple]) -> None:
        """Append ``(table, date, status, error, records)`` events, one per stage result."""
        self._record(run_id, rows)

    def _record(self, run_id: str, rows: list[tuple], file: str | None = None) -> None:
        seq, at = self._tick()
        shape = "table_name string, execution_date string, status string, error string, records bigint"
        events = small_frame(self.spark, rows, shape).select(
            "table_name",
            "execution_date",
            F.lit(file).cast("string").alias("file_name"),
            seq.cast("bigint").alias("seq"),
            at.alias("event_at"),
            "status",
            F.col("error").alias("error_message"),
            F.col("records").alias("records_processed"),
            F.lit(run_id).alias("run_id"),
        )
        self.table.append(events)

    def update_status(
        self,
        run_id: str,
        table_name: str,
        status: str,
        error_message: str | None = None,
        records_processed: int | None = None,
        execution_date: str | None = None,
    ) -> None:
        """Set a table's status for one date, or for every date the run opened."""
        keys = self.state(run_id).where(F.col("table_name") == table_name)
        if execution_date is not None:
            keys = keys.where(F.col("execution_date") == execution_date)
        self.table.append(
            fold.status_events(
                keys, status, *self._tick(), error=F.lit(error_message).cast("string"), records=F.lit(records_processed)
            )
        )

    def update_all_running(self, run_id: str, status: str, error_message: str | None = None) -> None:
        """Close every key of the run that is still running."""
        error = F.lit(error_message).cast("string")
        self.table.append(fold.closing_events(self.state(run_id), status, *self._tick(), error=error))

    def close(self, run_id: str, status: str) -> None:
        """Close every key of a run that is still running, and fold the run's events."""
        events = self.table.read({"run_id": run_id})
        closing = fold.closing_events(fold.current_state(events), status, *self._tick())
        self.fold(run_id, events.unionByName(closing))

    def fold(self, run_id: str, events: DataFrame | None = None) -> None:
        """Replace the events of a run, one or more files a batch, by a single file that gives the same state."""
        events = self.table.read({"run_id": run_id}) if events is None else events
        self.table.replace(fold.folded_events(events).coalesce(1), [run_id], rebalance=False, counted=False)
