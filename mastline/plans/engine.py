"""The pipeline stages, each one plan over all of its dates, and the whole run."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastline import schemas
from mastline.constants import (
    BRONZE,
    DAILY,
    DQ_LOG,
    ERROR_TEXT_LIMIT,
    FACT,
    FAIL,
    HOURLY,
    LEDGER,
    LINEAGE_COLUMNS,
    REQUIRED_COLUMNS,
    SILVER,
    SKETCHES,
    SKIPPED,
    SUCCESS,
    TRACKED_TABLES,
)
from mastline.functions.clock import utc_now
from mastline.operators import checks, clean, dedup, kinds, rollups, volume
from mastline.session import parts_of, size_shuffles, small_frame
from mastline.sinks.ledger import RunLedger
from mastline.sinks.tables import DatedTable, LayoutConflictError, all_equal
from mastline.sources import calendar, drops

_NAME = re.compile(r"\w+(\.\w+)*")
_TYPED = [c for c in REQUIRED_COLUMNS if c != "region"]


@dataclass
class Engine:
    """Daily reading files to bronze, silver and gold below ``base``.

    With ``dq_json``, a folder, the quality stage also writes its log there, a JSON array per date.

    ``source`` is the folder the daily files arrive in.  Every stage takes one
    date or many; many dates are one Spark job per write, not a loop.
    """

    spark: SparkSession
    source: str
    base: str
    tz: str = "UTC"
    strict: bool = False
    rows_per_file: int = 4_000_000
    sorted_rows: int = 1_000_000  # of a run, up to which sorting is the cheaper way to find first copies
    dq_json: str | None = None
    tables: dict[str, DatedTable] = field(init=False)
    ledger: RunLedger = field(init=False)

    def __post_init__(self) -> None:
        declared = {
            BRONZE: ("_execution_date", schemas.BRONZE_SCHEMA),
            SILVER: ("_execution_date", schemas.SILVER_SCHEMA),
            FACT: ("execution_date", schemas.FACT_SCHEMA),
            HOURLY: ("execution_date", schemas.HOURLY_SCHEMA),
            DAILY: ("execution_date", schemas.DAILY_SCHEMA),
            DQ_LOG: ("execution_date", schemas.DQ_SCHEMA),
            SKETCHES: ("execution_date", schemas.SKETCH_SCHEMA),
        }
        self.tables = {
            name: DatedTable(self.spark, self._path(name), key, schema)
            for name, (key, schema) in declared.items()
        }
        self.ledger = RunLedger(self.spark, self._path(LEDGER))

    def _path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name.replace('.', '/')}"

    # -- sources -----------------------------------------------------------

    def _spine(self, dates: list[str]) -> DataFrame:
        return small_frame(self.spark, [(d,) for d in dates], "execution_date string")

    def available(self, dates: str | list[str]) -> tuple[list[drops.Drop], list[str]]:
        """Found sources and missing dates among those asked for."""
        return drops.availability(self.spark, self._spine(_listed(dates)), self.source)

    def _columns_by_date(self, heads: dict[str, list[str]]) -> DataFrame:
        shape = "execution_date string, columns array<string>"
        return small_frame(self.spark, list(heads.items()), shape)

    # -- bronze ------------------------------------------------------------

    def ingest_bronze(
        self,
        dates: str | list[str],
        run_id: str,
        found: list[drops.Drop] | None = None,
        heads: dict[str, list[str]] | None = None,
    ) -> dict[str, int]:
        """Raw files to bronze; returns rows per date.

        Nothing is written if any date's columns changed type.
        """
        if found is None:
            found, lacking = self.available(dates)
            if lacking:
                raise FileNotFoundError(f"No source file for date(s): {lacking}")
        size_shuffles(self.spark, sum(d.bytes for d in found))
        heads = heads or drops.headers(self.spark, found)
        blank = [d.path for d in found if not heads[d.execution_date]]
        if blank:
            raise ValueError(f"No columns to parse from file(s): {blank}")
        raw = drops.scan(self.spark, found, heads)
        verdicts = kinds.schema_evolution(raw, self._columns_by_date(heads), strict=self.strict)
        kinds.require_stable_schema(verdicts)

        typed = raw.withColumns(
            {c: clean.DECLARED_CASTS[c](F.col(c)) for c in _TYPED if c in raw.columns}
        )
        bronze = typed.withColumns({"_run_id": F.lit(run_id), "_ingested_at": F.lit(utc_now())})
        # A scan split holds one date already: no regrouping needed.
        return self.tables[BRONZE].replace(bronze, [d.execution_date for d in found], rebalance=False)

    def read_bronze(self, dates: str | list[str]) -> DataFrame:
        return self.tables[BRONZE].read(dates=_listed(dates))

    # -- quality -----------------------------------------------------------

    def run_dq_checks(
        self, dates: str | list[str], run_id: str, heads: dict[str, list[str]] | None = None
    ) -> DataFrame:
        """Check bronze, replace the dates' log entries, then raise on a hard failure."""
        listed = _listed(dates)
        self._size_shuffles(self.tables[BRONZE], listed)
        bronze = self.read_bronze(listed)
        if heads is None:
            found, _ = self.available(listed)
            heads = drops.headers(self.spark, found)
        held = [c for c in bronze.columns if c not in (*LINEAGE_COLUMNS, "_row_seq")]
        present = {d: [*heads.get(d, held), *LINEAGE_COLUMNS] for d in listed}
        results = checks.run_checks(bronze, self._columns_by_date(present), tz=self.tz)
        stamped = results.withColumns({"checked_at": F.lit(utc_now()), "run_id": F.lit(run_id)})
        log = self.tables[DQ_LOG]
        log.replace(stamped, listed, counted=False)
        written = log.read(dates=listed)
        if self.dq_json:
            self.export_dq_json(listed, self.dq_json)
        checks.require_quality(written)
        return written

    def _checked(self, dates: list[str], run_id: str, heads: dict[str, list[str]]) -> dict:
        self.run_dq_checks(dates, run_id, heads)
        return {}

    def export_dq_json(self, dates: str | list[str], path: str) -> None:
        """The dates' log entries, as one JSON array per date in a folder of its own."""
        log = self.tables[DQ_LOG].read(dates=_listed(dates))
        place = F.array_position(F.array(*map(F.lit, [*checks.ALL_CHECKS, checks.EVOLUTION])), F.col("check_name"))
        entry = F.struct(place.alias("place"), F.struct(*log.columns).alias("entry"))  # eight a date at most
        arrays = log.groupBy("execution_date").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        text = F.to_json(F.transform("entries", lambda e: e["entry"]), {"ignoreNullFields": "false"})
        (
            arrays.select("execution_date", text.alias("value"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("execution_date")
            .text(path)
        )

    # -- silver ------------------------------------------------------------

    def process_silver(self, dates: str | list[str], run_id: str, rows: dict[str, int] | None = None) -> dict[str, int]:
        """Bronze to silver; returns clean rows per date.  ``rows`` has bronze rows per date, if known.

        Of more than ``sorted_rows`` rows each moves once, into the files of its date: which ones
        repeat an earlier key is found out beforehand from keys and places alone.
        """
        listed = _listed(dates)
        bronze = self.tables[BRONZE]
        self._size_shuffles(bronze, listed)
        rows = rows or bronze.counts(listed)
        largest = max(rows.values(), default=0)
        # Readings of a tower share a file, so gold combines them before its shuffle.
        files = -(-largest // self.rows_per_file)
        spread = F.pmod(F.xxhash64("tower_id"), F.lit(files)) if files > 1 else None
        raw = bronze.read(dates=listed)
        sorted_ = clean.clean_readings(raw, run_id, strict=self.strict)
        if sum(rows.values()) <= self.sorted_rows:
            return self.tables[SILVER].replace(sorted_, listed, spread=spread)
        ranks = dedup.part_ranks(raw, "_execution_date").persist()
        files_read = ranks.agg(F.count("*").alias("n"), F.max("part").alias("last")).first()
        if files_read.n > dedup.REPEATED_KEYS:  # too many to send to all tasks: order by sorting
            return self.tables[SILVER].replace(sorted_, listed, spread=spread)
        keyed = clean.with_position(clean.keyed_readings(raw, self.strict), ranks if files_read.last else None)
        repeated = clean.repeats(keyed).persist(StorageLevel.DISK_ONLY)
        try:
            tidy = clean.finished(clean.without_repeats(keyed, repeated), run_id)
            return self.tables[SILVER].replace(tidy, listed, spread=spread)
        finally:
            repeated.unpersist()
            ranks.unpersist()

    def _size_shuffles(self, table: DatedTable, dates: list[str]) -> None:
        """Shuffles as wide as what is read of a table asks for; Parquet rows take some four times their bytes as CSV does."""
        size_shuffles(self.spark, table.bytes(dates))

    def read_silver(self, dates: str | list[str]) -> DataFrame:
        return self.tables[SILVER].read(dates=_listed(dates))

    # -- gold --------------------------------------------------------------

    def process_gold(self, dates: str | list[str], run_id: str) -> dict[str, dict[str, int]]:
        """Silver to the three aggregates; returns rows per table and date.

        Silver is scanned once, into one row per region, hour, tower and date, and these are merged
        once into one per region, tower and date.  Both are kept on the executors' disks, in as many
        parts as their size asks for, while the three tables are written from them; a lost
        executor's share is computed again.
        """
        listed = _listed(dates)
        silver_bytes = self.tables[SILVER].bytes(listed)
        wide = size_shuffles(self.spark, silver_bytes)
        # A stored frame keeps its shuffle's width, and each part opens a file for each of the next
        # shuffle's.  A state takes some four times the bytes of a reading.
        parts = min(wide, max(2 * self.spark.sparkContext.defaultParallelism, parts_of(self.spark, 4 * silver_bytes)))
        base = rollups.base_states(self.read_silver(listed)).coalesce(parts).persist(StorageLevel.DISK_ONLY)
        by_tower = rollups.tower_states(base).coalesce(parts).persist(StorageLevel.DISK_ONLY)
        try:
            # Side by side: all three wait for, and then share, the one shuffle of the scan.
            built = rollups.from_base(base, by_tower)
            with ThreadPoolExecutor(len(built)) as pool:
                writes = {
                    name: pool.submit(self.tables[name].replace, frame, listed, sort=rollups.ORDERS[name])
                    for name, frame in built.items()
                }
            return {name: write.result() for name, write in writes.items()}
        finally:
            by_tower.unpersist()
            base.unpersist()

    def write_tower_sketches(self, dates: str | list[str]) -> None:
        """Silver to mergeable sketches per region and hour: an addition to the exact counts, not their replacement."""
        listed = _listed(dates)
        self.tables[SKETCHES].replace(rollups.tower_sketches(self.read_silver(listed)), listed, counted=False)

    def approximate_towers(self, dates: str | list[str], keys: list[str]) -> DataFrame:
        """Approximate tower and exact record counts of any grain of region, hour and date, from the sketches of ``dates``."""
        return rollups.approximate_towers(self.tables[SKETCHES].read(dates=_listed(dates)), keys)

    def received_volume(self, start: str, end: str, **limits: float) -> DataFrame:
        """How many rows each date of a range brought to bronze, next to the last date that brought any."""
        spine = calendar.date_spine(self.spark, start, end)
        held = self.tables[BRONZE].read().where(F.col("_execution_date").between(start, end))
        return volume.received_volume(volume.row_counts(held), spine, **limits)

    def read_gold(self, name: str, dates: str | list[str] | None = None) -> DataFrame:
        """An aggregate in presentation order: by date, then by its own keys."""
        frame = self.tables[name].read(dates=None if dates is None else _listed(dates))
        return frame.orderBy("execution_date", *rollups.ORDERS[name])

    # -- tables ------------------------------------------------------------

    def read_table(self, name: str, filters: dict | None = None) -> DataFrame:
        """Any table by name, rows meeting every filter; an empty frame if there is none.

        The ledger reads as its current state.
        """
        if name == LEDGER:
            return self.ledger.state().where(all_equal(filters or {}))
        return self._table(name).read(filters)

    def write_table(
        self,
        name: str,
        df: DataFrame,
        key: str | list[str] | None = None,
        values: list | None = None,
        where: dict | None = None,
    ) -> dict:
        """Write ``df`` into a table of any name, made with the partition columns ``key`` if there is none.

        An existing table keeps its partition columns; naming others is refused.

        With ``where`` the rows meeting all of its equality conditions, on any columns, are
        deleted first.  Without it and with one partition column, ``df`` becomes the whole
        content of its values of that column; ``values`` names them, also those that ``df`` has
        no rows for and that are emptied (otherwise they are looked up, one row per
        partition).  Returns rows per value in that case.  Other partition columns need ``where``
        or ``append_table``.
        """
        table = self._writable(name, key)
        if where is not None:
            table.overwrite(df, where)
            return {}
        if table.key is None:
            raise ValueError(f"{name} has not one partition column: name the rows to replace, or append")
        if values is None:
            values = [r[0] for r in df.select(table.key).distinct().collect()]
        return table.replace(df, values) if values else {}

    def append_table(self, name: str, df: DataFrame, key: str | list[str] | None = None) -> None:
        """Add rows to a table of any name; nothing is deleted."""
        self._writable(name, key).append(df)

    def delete_rows(self, name: str, where: dict) -> None:
        """Delete a table's rows meeting every filter."""
        if name == LEDGER:
            raise ValueError(f"{name} is only written by runs")
        self._table(name).delete(where)

    def _writable(self, name: str, key: str | list[str] | None) -> DatedTable:
        if name == LEDGER:
            raise ValueError(f"{name} is only written by runs")
        keys = [key] if isinstance(key, str) else list(key or [])
        table = self._table(name, keys)
        if key is not None and table.keys != keys:
            raise LayoutConflictError(f"{name} is partitioned by {table.keys or 'nothing'}, not {keys or 'nothing'}")
        return table

    def _table(self, name: str, keys: list[str] | None = None) -> DatedTable:
        if name in self.tables:
            return self.tables[name]
        if not _NAME.fullmatch(name):
            raise ValueError(f"not a table name: {name!r}")
        table = DatedTable(self.spark, self._path(name))
        if table.schema() is None:  # else its log knows the layout
            table.keys = keys or []
        if keys is not None:
            self.tables[name] = table
        return table

    # -- whole run ---------------------------------------------------------

    def run(
        self,
        run_id: str,
        logical_date: str,
        start: str | None = None,
        end: str | None = None,
    ) -> DataFrame:
        """Daily run, or backfill when both ``start`` and ``end`` are given.

        Dates without a source are skipped, the others go on.  Returns the
        run's ledger rows.
        """
        return self._run(run_id, calendar.resolve_dates(self.spark, logical_date, start, end))

    def run_dates(self, run_id: str, dates: list[str]) -> DataFrame:
        """A run over any set of dates."""
        return self._run(run_id, self._spine(dates))

    def _run(self, run_id: str, spine: DataFrame) -> DataFrame:
        self.ledger.open(run_id, spine)
        found, lacking = drops.availability(self.spark, spine, self.source)
        if lacking:
            # Each row names its own date, so the text does not grow with the range.
            notes = [(t, d, SKIPPED, f"No source file for date(s): {[d]}", None) for d in lacking for t in TRACKED_TABLES]
            self.ledger.record(run_id, notes)
        if not found:
            return self.ledger.state(run_id)
        dates = [d.execution_date for d in found]
        heads = drops.headers(self.spark, found)
        rows = self._stage(run_id, [BRONZE], dates, lambda: {BRONZE: self.ingest_bronze(dates, run_id, found, heads)})
        self._stage(run_id, [SILVER], dates, lambda: self._checked(dates, run_id, heads))
        self._stage(run_id, [SILVER], dates, lambda: {SILVER: self.process_silver(dates, run_id, rows[BRONZE])})
        self._stage(run_id, [FACT, HOURLY, DAILY], dates, lambda: self.process_gold(dates, run_id))
        self.ledger.close(run_id, SUCCESS)
        return self.ledger.state(run_id)

    def _stage(self, run_id: str, names: list[str], dates: list[str], work) -> dict[str, dict[str, int]]:
        """Run one stage and book its outcome on the tables it stands for; returns rows per table and date."""
        try:
            counts = work()
        except Exception as error:
            text = str(error)[:ERROR_TEXT_LIMIT]
            self.ledger.record(run_id, [(t, d, FAIL, text, None) for t in names for d in dates])
            raise
        rows = [(t, d, SUCCESS, None, n) for t, per_date in counts.items() for d, n in per_date.items()]
        if rows:
            self.ledger.record(run_id, rows)
        return counts


def _listed(dates: str | list[str]) -> list[str]:
    return [dates] if isinstance(dates, str) else list(dates)
