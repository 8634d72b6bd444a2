"""Parquet tables: replace by partition value or by filter, append, additive schema evolution, filtered reads."""

from __future__ import annotations

import datetime
import json
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mastline.functions.clock import utc_now
from mastline.session import small_frame
from mastline.sinks.files import Folder, partition_folder

# Characters of a path pattern that Spark leaves as they are in the folder of a partition value.
_PATTERN = set(",}")


class SchemaConflictError(ValueError):
    """An incoming column has another type than the table's column of that name."""


class LayoutConflictError(ValueError):
    """A table is written with other partition columns than it was created with."""


def all_equal(filters: dict) -> Column:
    """Equality conditions, all of which must hold; None stands for a missing value."""
    return reduce(
        lambda a, b: a & b,
        (F.col(c).isNull() if v is None else F.col(c) == F.lit(v) for c, v in filters.items()),
        F.lit(True),
    )


def union_evolved(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column missing from one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _lacking(schema: T.StructType | None, incoming: T.StructType) -> list[T.StructField]:
    known = set(schema.names) if schema else set()
    return [T.StructField(f.name, f.dataType) for f in incoming if f.name not in known]


class DatedTable:
    """A Parquet dataset partitioned by one column (a date, usually), by several or by none.

    The table's column list and partition columns are kept as a small append-only log beside
    the data (``_schema``, hidden from scans), so a read neither infers a schema nor merges file
    footers, however many files the table has.  Columns only ever get added: old rows
    read NULL for a new column, and new rows read NULL for a column their source no longer has.

    Whole partitions are replaced by dynamic overwrite.  Rows chosen by any other filter are
    replaced at the level of files: only files that hold such a row are written again.  The
    new files are staged out of sight, a record names them and the files they stand for, and
    only then are files exchanged; the next use of the table ends an exchange that was cut short.
    One writer at a time is assumed.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str | list[str] | None = None,
        declared: T.StructType | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = [key] if isinstance(key, str) else list(key or [])
        self.declared = declared
        self._schema: T.StructType | None = None
        self._files: Folder | None = None

    @property
    def key(self) -> str | None:
        """The partition column, if there is just one."""
        return self.keys[0] if len(self.keys) == 1 else None

    @property
    def files(self) -> Folder:
        self._files = self._files or Folder(self.spark, self.path)
        return self._files

    # -- schema ------------------------------------------------------------

    def schema(self, refresh: bool = False) -> T.StructType | None:
        """The evolved schema, or None while the table does not exist.

        Remembered once read; ``refresh`` picks up columns another session added.
        """
        if self._schema is None or refresh:
            self._schema, keys = self._logged()
            if keys is not None and not self.keys:
                self.keys = keys
        return self._schema

    def _logged(self) -> tuple[T.StructType | None, list[str] | None]:
        """Columns and partition columns by the log."""
        try:
            log = self.spark.read.schema("at string, fields string, keys array<string>").json(f"{self.path}/_schema")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None, None
            raise
        merged: dict[str, T.StructField] = {}
        keys = None
        # One row per evolution of the table, not per data row.
        for row in sorted(log.collect(), key=lambda r: (r.at, r.keys is None, r.fields)):
            keys = row.keys if keys is None else keys
            for field in T.StructType.fromJson(json.loads(row.fields)):
                merged.setdefault(field.name, field)
        return T.StructType(list(merged.values())), keys

    def evolve(self, incoming: T.StructType) -> T.StructType:
        """Add the columns the table lacks; return its new schema."""
        lost = [c for c in self.keys if c not in incoming.names]
        if lost:
            raise SchemaConflictError(f"{self.path}: no partition column {', '.join(lost)}")
        if self._schema is None or _lacking(self._schema, incoming):
            self._schema, keys = self._logged()
            if keys is not None and keys != self.keys:
                raise LayoutConflictError(f"{self.path} is partitioned by {keys or 'nothing'}, not {self.keys or 'nothing'}")
        current = self._schema or T.StructType()
        types = {f.name: f.dataType for f in current}
        clashes = [
            f"{f.name}: table has {types[f.name].simpleString()}, got {f.dataType.simpleString()}"
            for f in incoming
            if types.get(f.name, f.dataType) != f.dataType
        ]
        if clashes:
            raise SchemaConflictError(f"{self.path}: {'; '.join(clashes)}")
        added = _lacking(current, incoming)
        if added or self._schema is None:
            keys = self.keys if self._schema is None else None
            entry = [(utc_now(), json.dumps(T.StructType(added).jsonValue()), keys)]
            log = small_frame(self.spark, entry, "at string, fields string, keys array<string>")
            log.write.mode("append").json(f"{self.path}/_schema")
            self._schema = T.StructType([*current, *added])
        return self._schema

    # -- reads -------------------------------------------------------------

    def read(self, filters: dict | None = None, dates: list | None = None) -> DataFrame:
        """Rows meeting every filter; an empty frame while the table does not exist.

        ``dates``, or a filter on the one partition column, limits the read to those
        partitions, files of others are not even listed.
        """
        if self.schema() is None:
            return self.spark.createDataFrame([], self.declared or T.StructType())
        self._settle()
        found = self._stored(filters or {}, dates)
        return self.spark.createDataFrame([], self._schema) if found is None else found

    def _stored(self, filters: dict, values: list | None = None) -> DataFrame | None:
        if values is None and self.key in filters:
            values = [filters[self.key]]
        found = self._partitions(values)
        return None if found is None else found.where(all_equal(filters))

    def _partitions(self, values: list | None) -> DataFrame | None:
        reader = self.spark.read.schema(self._schema)
        if values is None:
            return self._found(reader, self.path)
        wanted = F.col(self.key).isin([v for v in values if v is not None])
        if None in values:
            wanted = F.coalesce(wanted, F.lit(False)) | F.col(self.key).isNull()
        folders = [self._folder(v) for v in values]
        if any(_PATTERN & set(f) for f in folders):
            found = self._found(reader, self.path)
        else:
            found = self._found(reader.option("basePath", self.path), self._pattern(folders))
        return None if found is None else found.where(wanted)

    @staticmethod
    def _found(reader, path: str) -> DataFrame | None:
        try:
            return reader.parquet(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _folder(self, value) -> str:
        """Folder of a value of the one partition column."""
        if value is None or isinstance(value, str):
            text = value
        elif isinstance(value, bool):
            text = str(value).lower()
        elif isinstance(value, (int, datetime.date)) and not isinstance(value, datetime.datetime):
            text = str(value)
        else:  # as Spark spells it
            text = self.spark.range(1).select(F.lit(value).cast(self.schema()[self.key].dataType).cast("string")).first()[0]
        return partition_folder(self.key, text)

    def _pattern(self, folders: list[str]) -> str:
        """Path of some folders; unlike a list of paths it may name absent ones."""
        return f"{self.path}/{{{','.join(folders)}}}"

    def counts(self, values: list) -> dict:
        """Rows per value of the partition column, from file footers alone; at most one row per value asked for."""
        stored = {}
        if self.schema() is not None:
            stored = dict(self.read(dates=values).groupBy(self.key).count().collect())
        return {v: stored.get(v, 0) for v in values}

    # -- writes ------------------------------------------------------------

    def append(self, df: DataFrame) -> None:
        self.evolve(df.schema)
        self._settle()
        self._writer(df).mode("append").parquet(self.path)

    def _writer(self, df: DataFrame):
        return df.write.partitionBy(*self.keys) if self.keys else df.write

    def replace(
        self,
        df: DataFrame,
        dates: list,
        spread: Column | None = None,
        sort: list[str] | None = None,
        rebalance: bool = True,
        counted: bool = True,
    ) -> dict:
        """Make ``df`` the whole content of ``dates``, values of the partition column; others stay as they are.

        With ``rebalance`` rows are regrouped by date (and by ``spread``, an
        expression that keeps related rows in one file) before the write, so a
        many-date job does not leave one small file per task and date.  The
        regrouping is adaptive: a date too large for one task is split, small
        ones share a task.  Returns rows per date, if ``counted``.
        """
        if self.key is None:
            raise LayoutConflictError(f"{self.path} has not one partition column: overwrite it by a filter")
        existed = self.schema() is not None
        self.evolve(df.schema)
        self._settle()
        out = df
        if rebalance:
            columns = [F.col(self.key)]
            if spread is not None:
                out = out.withColumn("__spread", spread)
                columns.append(F.col("__spread"))
            out = out.hint("rebalance", *columns).drop("__spread")
        if sort:
            out = out.sortWithinPartitions(self.key, *sort)
        seen = Observation()
        filled = F.collect_set(F.coalesce(F.col(self.key).cast("string"), F.lit("")))  # as many as dates
        out = out.observe(seen, filled.alias("filled"))
        self._writer(out).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
        if existed:
            # Dynamic overwrite leaves a date alone when it got no rows at all.
            written = {partition_folder(self.key, text) for text in seen.get["filled"] or []}
            for folder in {self._folder(d) for d in dates} - written:
                self.files.delete(folder)
        return self.counts(dates) if counted else {}

    def bytes(self, dates: list) -> int:
        """Bytes of the files of some values of the partition column, or of all files, by their listing."""
        found = self._partitions(dates) if self.schema() is not None else None
        return int(str(found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) if found is not None else 0

    def delete(self, filters: dict) -> None:
        """Delete the rows meeting every filter; with none, all of them."""
        if self.schema() is not None:
            self._exchange(filters, None)

    def overwrite(self, df: DataFrame, filters: dict) -> None:
        """Delete the rows meeting every filter, on any columns, and append ``df``, as one step."""
        existed = self.schema() is not None
        self.evolve(df.schema)
        if existed:
            self._exchange(filters, df)
        else:
            self.append(df)

    def _exchange(self, filters: dict, df: DataFrame | None) -> None:
        self._settle()
        unknown = [c for c in filters if c not in self._schema.names]
        if unknown:
            raise ValueError(f"{self.path} has no column {', '.join(unknown)}")
        hit = F.coalesce(all_equal(filters), F.lit(False))
        # One row per file that has to be written again.
        found = self._stored(filters)
        touched = found.select("_metadata.file_path").distinct().collect() if found is not None else []
        gone = [self.files.relative(r[0]) for r in touched]
        stays = None
        if gone and not set(filters) <= set(self.keys):  # else nothing of those files stays
            reader = self.spark.read.schema(self._schema).option("basePath", self.path)
            stays = reader.parquet(*(f"{self.path}/{f}" for f in gone)).where(~hit)
        frames = [f for f in (stays, df) if f is not None]
        number = uuid.uuid4().hex
        staged = f"_staged-{number}"
        if frames:
            out = union_evolved(frames)
            if self.keys:
                out = out.hint("rebalance", *map(F.col, self.keys))
            self._writer(out).parquet(f"{self.path}/{staged}")
        if gone or frames:
            record = small_frame(self.spark, [(staged, gone)], "staged string, gone array<string>")
            record.write.json(f"{self.path}/_pending/{number}")
            self._settle()

    def _settle(self) -> None:
        """End the exchanges that are recorded: files that were written again go, the staged ones come."""
        if not self.files.exists("_pending"):
            return
        for row in self.spark.read.schema("staged string, gone array<string>").json(f"{self.path}/_pending/*").collect():
            for file in row.gone or []:
                self.files.delete(file)
            for file in self.files.files(row.staged):
                self.files.move(file, file.removeprefix(f"{row.staged}/"))
            self.files.delete(row.staged)
        self.files.delete("_pending")
