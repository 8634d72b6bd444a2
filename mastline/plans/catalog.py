"""Every operator as a runnable query over the given tables.

Each entry pairs a Spark query ``(spark, folder) -> DataFrame`` with the SQL
that another engine can run on the same tables for the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mastline.constants import DAILY, FACT, HOURLY, NATURAL_KEY, REQUIRED_COLUMNS
from mastline.functions import clock
from mastline.operators import checks, clean, dedup, kinds, ledger, rollups, rules, volume
from mastline.plans.engine import Engine
from mastline.schemas import BRONZE_SCHEMA
from mastline.session import scratch_path, shared_split, small_splits
from mastline.sinks.tables import DatedTable, all_equal, union_evolved
from mastline.sources import calendar, drops
from mastline.sources.adapters import faulty_readings, readings, text_readings, write_drops


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str


CATALOG: dict[str, Query] = {}
BRONZE_COLUMNS = [c for c in BRONZE_SCHEMA.names if c != "_row_seq"]


def query(name: str, sql: str):
    def register(build):
        CATALOG[name] = Query(build, sql)
        return build

    return register


# -- SQL building blocks ---------------------------------------------------

# Clean readings, and readings as text with faults put in by rule.
_R = """r AS (
  SELECT event_id AS seq, user_id AS tower_id, event_type AS region,
         CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp",
         CAST(-120.0 AS DOUBLE) + value AS signal_strength, value AS data_volume_mb,
         strftime(ts, '%Y-%m-%d') AS execution_date
  FROM events)"""


def _x(bad: str = "'bad'", odd: str = "'n/a'") -> str:
    return f"""{_R}, x AS (
  SELECT seq + copy * 1000000000 AS seq,
         CASE WHEN seq % 19 = 0 THEN {bad} ELSE CAST(tower_id AS VARCHAR) END AS tower_id,
         CASE WHEN seq % 17 <> 0 THEN region END AS region,
         CASE WHEN seq % 37 <> 0 THEN CAST("timestamp" + CASE WHEN seq % 31 = 0 THEN 86400 ELSE 0 END AS VARCHAR)
         END AS "timestamp",
         CASE WHEN seq % 23 = 0 THEN {odd} ELSE CAST(signal_strength AS VARCHAR) END AS signal_strength,
         CAST(CASE WHEN seq % 29 = 0 THEN -(data_volume_mb + copy) ELSE data_volume_mb + copy END AS VARCHAR)
           AS data_volume_mb,
         execution_date
  FROM r, (VALUES (0), (1)) c(copy)
  WHERE copy = 0 OR seq % 10 = 0)"""


def _typed(bad: str = "'bad'", odd: str = "'n/a'") -> str:
    return f"""{_x(bad, odd)}, t AS (
  SELECT seq, TRY_CAST(tower_id AS BIGINT) AS tower_id, region, TRY_CAST("timestamp" AS BIGINT) AS "timestamp",
         TRY_CAST(signal_strength AS DOUBLE) AS signal_strength,
         TRY_CAST(data_volume_mb AS DOUBLE) AS data_volume_mb, execution_date
  FROM x)"""


def _silver(bad: str = "'bad'", odd: str = "'n/a'") -> str:
    return f"""{_typed(bad, odd)}, s AS (
  SELECT *, make_timestamp("timestamp" * 1000000) AS event_datetime,
         strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d') AS event_date,
         CAST(hour(make_timestamp("timestamp" * 1000000)) AS INTEGER) AS event_hour
  FROM t
  WHERE tower_id IS NOT NULL AND region IS NOT NULL AND "timestamp" IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY execution_date, tower_id, region, "timestamp" ORDER BY seq) = 1)"""


_R_TIMED = f"""{_R}, g AS (
  SELECT *, CAST(hour(make_timestamp("timestamp" * 1000000)) AS INTEGER) AS event_hour FROM r)"""


def _exact(column: str) -> str:
    """Sum of whole millionths as integers, so row order cannot matter."""
    return f"(CAST(SUM(CAST(round_even({column} * 1e6, 0) AS BIGINT)) AS DOUBLE) / 1e6)"


def _half_even(expression: str, places: int) -> str:
    return f"round_even(({expression}) * 1e{places}, 0) / 1e{places}"


_TOTAL = _half_even(f"COALESCE({_exact('data_volume_mb')}, 0)", 2) + " AS total_data_volume_mb"
_MEAN = _half_even(f"{_exact('signal_strength')} / COUNT(signal_strength)", 4) + " AS avg_signal_strength"


def _fact_sql(source: str) -> str:
    return f"""SELECT tower_id, region, {_MEAN},
  {_half_even("MIN(signal_strength)", 4)} AS min_signal_strength,
  {_half_even("MAX(signal_strength)", 4)} AS max_signal_strength,
  {_half_even("stddev_samp(signal_strength)", 4)} AS stddev_signal_strength,
  {_TOTAL}, {_half_even(_exact("data_volume_mb") + " / COUNT(data_volume_mb)", 2)} AS avg_data_volume_mb,
  COUNT("timestamp") AS reading_count, execution_date
FROM {source} GROUP BY tower_id, region, execution_date"""


def _rollup_sql(source: str, keys: str) -> str:
    return f"""SELECT {keys}, {_TOTAL}, {_MEAN}, COUNT(DISTINCT tower_id) AS tower_count,
  COUNT("timestamp") AS record_count, execution_date
FROM {source} GROUP BY {keys}, execution_date"""


# -- sources and calendar --------------------------------------------------


@query(
    "file_names",
    """SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS execution_date,
  'network_metrics_' || strftime(ts, '%Y%m%d') || '.csv' AS file_name,
  strftime(ts, '%Y-%m-%d') AS date_in_name FROM events""",
)
def file_names(spark, folder):
    dates = readings(spark, folder).select(F.col("_execution_date").alias("execution_date")).distinct()
    named = dates.withColumn("file_name", clock.file_name_of(F.col("execution_date")))
    return named.withColumn("date_in_name", clock.date_in_path(F.concat(F.lit("/in/"), "file_name")))


_WIDE_SPINE = """spine AS (
  SELECT strftime(unnest(generate_series(MIN(ts)::DATE - 3, MAX(ts)::DATE + 3, INTERVAL 1 DAY)), '%Y-%m-%d')
    AS execution_date FROM events)"""


@query("date_spine", f"WITH {_WIDE_SPINE} SELECT execution_date FROM spine")
def date_spine(spark, folder):
    return calendar.covered_range(readings(spark, folder), "_execution_date", margin=3)


@query(
    "run_dates",
    f"""WITH {_R}, e AS (
  SELECT region, MIN(execution_date) AS first, MAX(execution_date) AS last FROM r GROUP BY region)
SELECT region, 'range' AS run_kind,
  strftime(unnest(generate_series(first::DATE, last::DATE, INTERVAL 1 DAY)), '%Y-%m-%d') AS execution_date FROM e
UNION ALL SELECT region, 'one_end', first FROM e""",
)
def run_dates(spark, folder):
    ends = readings(spark, folder).groupBy("region").agg(
        F.min("_execution_date").alias("first"), F.max("_execution_date").alias("last")
    )
    first, last, none = F.col("first"), F.col("last"), F.lit(None).cast("string")
    runs = F.array(
        F.struct(F.lit("range").alias("run_kind"), calendar.run_dates(first, first, last).alias("dates")),
        F.struct(F.lit("one_end").alias("run_kind"), calendar.run_dates(first, none, last).alias("dates")),
        F.struct(F.lit("reversed").alias("run_kind"), calendar.run_dates(first, F.date_add(last, 1).cast("string"), first).alias("dates")),
    )
    return ends.select("region", F.inline(runs)).select(
        "region", "run_kind", F.explode("dates").alias("execution_date")
    )


def _arrivals(spark, folder):
    return readings(spark, folder).select(F.col("_execution_date").alias("execution_date")).distinct()


@query(
    "missing_dates",
    f"WITH {_WIDE_SPINE} SELECT execution_date FROM spine"
    " WHERE execution_date NOT IN (SELECT strftime(ts, '%Y-%m-%d') FROM events)",
)
def missing_dates(spark, folder):
    return drops.missing(date_spine(spark, folder), _arrivals(spark, folder))


@query(
    "arrived_dates",
    f"WITH {_WIDE_SPINE} SELECT execution_date FROM spine"
    " WHERE execution_date IN (SELECT strftime(ts, '%Y-%m-%d') FROM events)",
)
def arrived_dates(spark, folder):
    return drops.arrived(date_spine(spark, folder), _arrivals(spark, folder))


# -- files in, tables out --------------------------------------------------

def _clean_source(spark, folder) -> str:
    path = scratch_path(spark, "drops")
    write_drops(readings(spark, folder), path)
    return path


@query("source_manifest", f"WITH {_R} SELECT DISTINCT execution_date, TRUE AS has_bytes FROM r")
def source_manifest(spark, folder):
    found = drops.manifest(spark, _clean_source(spark, folder))
    return found.select("execution_date", (F.col("bytes") > 0).alias("has_bytes"))


_LINEAGE_SQL = (
    "'scan' AS _run_id, 'network_metrics_' || replace(execution_date, '-', '') || '.csv' AS _source_file,"
    " execution_date AS _execution_date"
)


@query(
    "bronze_roundtrip",
    f"""WITH {_R} SELECT tower_id, region, "timestamp", signal_strength, data_volume_mb, {_LINEAGE_SQL} FROM r""",
)
def bronze_roundtrip(spark, folder):
    source = _clean_source(spark, folder)
    engine = Engine(spark, source, scratch_path(spark, "bronze"))
    dates = [r.execution_date for r in drops.manifest(spark, source).select("execution_date").collect()]
    engine.ingest_bronze(dates, "scan")
    return engine.read_bronze(dates).drop("_ingested_at", "_row_seq")


# A region of several lines, with commas and quotes in it, or none at all.
_MULTILINE_SQL = """CASE seq % 4 WHEN 0 THEN region || chr(10) || 'of ' || seq
  WHEN 1 THEN region || ', "' || chr(10) || chr(10) || '"' WHEN 2 THEN region END"""


@query(
    "multiline_roundtrip",
    f"""WITH {_R} SELECT tower_id, {_MULTILINE_SQL} AS region, "timestamp", signal_strength, data_volume_mb, {_LINEAGE_SQL},
  row_number() OVER (PARTITION BY execution_date ORDER BY seq) AS place FROM r""",
)
def multiline_roundtrip(spark, folder):
    """Fields with line breaks in files that are read in several splits; the rows' order in the file is kept."""
    source, seq = scratch_path(spark, "drops"), F.col("seq")
    region = (
        F.when(seq % 4 == 0, F.concat("region", F.lit("\n of "), seq.cast("string")))
        .when(seq % 4 == 1, F.concat("region", F.lit(', "\n\n"')))
        .when(seq % 4 == 2, F.col("region"))
    )
    write_drops(readings(spark, folder).withColumn("region", F.replace(region, F.lit("\n of "), F.lit("\nof "))), source)
    engine = Engine(spark, source, scratch_path(spark, "bronze"))
    sizes = dict(drops.manifest(spark, source).select("execution_date", "bytes").collect())
    dates = list(sizes)
    with small_splits(spark, shared_split(spark, list(sizes.values()))):  # also of small files several tasks share one
        engine.ingest_bronze(dates, "scan")
    stored = engine.read_bronze(dates)
    order = Window.partitionBy("_execution_date").orderBy("_row_seq.part", "_row_seq.block", "_row_seq.row")
    return stored.withColumn("place", F.row_number().over(order).cast("long")).drop("_ingested_at", "_row_seq")


def _table(spark, name: str) -> DatedTable:
    return DatedTable(spark, scratch_path(spark, name), "_execution_date")


def _dates_of(df: DataFrame) -> list[str]:
    return [r[0] for r in df.select("_execution_date").distinct().orderBy("_execution_date").collect()]


_STORED = f"WITH {_R} SELECT * EXCLUDE (execution_date), execution_date AS _execution_date FROM r"


def _stored(spark, folder):
    """All readings as a dated table, each date written twice."""
    table, source = _table(spark, "stored"), readings(spark, folder)
    dates = _dates_of(source)
    table.replace(source, dates)
    table.replace(source, dates)
    return table, source, dates


@query("overwrite_reload", _STORED)
def overwrite_reload(spark, folder):
    table, source, dates = _stored(spark, folder)
    table.replace(source.where(F.col("_execution_date") == dates[0]), dates[:1])
    return table.read()


@query("overwrite_emptied", f"{_STORED} WHERE execution_date > (SELECT MIN(execution_date) FROM r)")
def overwrite_emptied(spark, folder):
    """A reload that finds no rows for its date clears that date."""
    table, source, dates = _stored(spark, folder)
    table.replace(source.where(F.lit(False)), dates[:1])
    return table.read()


@query(
    "filtered_read",
    f"{_STORED} WHERE region = 'click' AND execution_date = (SELECT MAX(execution_date) FROM r)",
)
def filtered_read(spark, folder):
    table, _, dates = _stored(spark, folder)
    return table.read({"region": "click", "_execution_date": dates[-1]})


@query(
    "any_table_roundtrip",
    f"""WITH {_R} SELECT seq, region, execution_date AS day FROM r
WHERE NOT (region = 'click' AND execution_date = (SELECT MAX(execution_date) FROM r))""",
)
def any_table_roundtrip(spark, folder):
    """A table of the caller's own name and partition column, one day of it written again with fewer rows."""
    base = scratch_path(spark, "lake")
    engine = Engine(spark, base, base)
    rows = readings(spark, folder).select("seq", "region", F.col("_execution_date").alias("day"))
    last = max(engine.write_table("mine.by_day", rows, "day"))
    engine.write_table("mine.by_day", rows.where((F.col("day") == last) & (F.col("region") != "click")), "day", [last])
    return Engine(spark, base, base).read_table("mine.by_day")


@query("unknown_table_empty", f"WITH {_R} SELECT execution_date AS day, COUNT(*) AS n FROM r GROUP BY 1")
def unknown_table_empty(spark, folder):
    """A table that nobody wrote adds no rows."""
    base = scratch_path(spark, "lake")
    rows = readings(spark, folder).groupBy(F.col("_execution_date").alias("day")).agg(F.count("*").alias("n"))
    return rows.unionByName(Engine(spark, base, base).read_table("mine.none"), allowMissingColumns=True)


def _lake(spark):
    base = scratch_path(spark, "lake")
    return Engine(spark, base, base), Engine(spark, base, base)  # one writes, another reads


@query(
    "overwrite_by_filter",
    f"""WITH {_R} SELECT seq, region, data_volume_mb, execution_date AS day FROM r WHERE region <> 'click'
UNION ALL SELECT -seq, region, data_volume_mb + 1, execution_date FROM r WHERE region = 'click' AND seq % 2 = 0""",
)
def overwrite_by_filter(spark, folder):
    """Rows of one region, which is no partition column, are replaced over all days."""
    writer, reader = _lake(spark)
    rows = readings(spark, folder).select("seq", "region", "data_volume_mb", F.col("_execution_date").alias("day"))
    writer.write_table("mine.by_day", rows, "day")
    clicks = rows.where("region = 'click' and seq % 2 = 0").withColumns({"seq": -F.col("seq"), "data_volume_mb": F.col("data_volume_mb") + 1})
    writer.write_table("mine.by_day", clicks, where={"region": "click"})
    return reader.read_table("mine.by_day")


@query(
    "two_partition_columns",
    f"""WITH {_R} SELECT seq, region, execution_date AS day, NULL::VARCHAR AS note FROM r
WHERE NOT (region = 'click' AND execution_date = (SELECT MAX(execution_date) FROM r)) AND region <> 'error'
UNION ALL SELECT seq, region, execution_date, 'again' FROM r
WHERE region = 'click' AND execution_date = (SELECT MAX(execution_date) FROM r)""",
)
def two_partition_columns(spark, folder):
    """One pair of partition values is replaced by rows with a new column, all pairs of one value are deleted."""
    writer, reader = _lake(spark)
    rows = readings(spark, folder).select("seq", "region", F.col("_execution_date").alias("day"))
    writer.append_table("mine.pairs", rows, ["region", "day"])
    one = {"region": "click", "day": _dates_of(readings(spark, folder))[-1]}
    again = rows.where(all_equal(one)).withColumn("note", F.lit("again"))
    writer.write_table("mine.pairs", again, ["region", "day"], where=one)
    writer.delete_rows("mine.pairs", {"region": "error"})
    return reader.read_table("mine.pairs")


@query(
    "unpartitioned_append",
    f"""WITH {_R} SELECT seq, region, CASE WHEN seq % 2 = 0 THEN data_volume_mb END AS data_volume_mb FROM r
WHERE NOT (seq % 2 = 0 AND region = 'view')""",
)
def unpartitioned_append(spark, folder):
    """A table without partition columns, appended to with a new column, and some of its rows deleted."""
    writer, reader = _lake(spark)
    rows = readings(spark, folder).select("seq", "region", "data_volume_mb")
    writer.append_table("mine.rows", rows.where("seq % 2 = 0"))
    writer.delete_rows("mine.rows", {"region": "view"})
    writer.append_table("mine.rows", rows.where("seq % 2 = 1").drop("data_volume_mb"))
    return reader.read_table("mine.rows")


@query(
    "typed_key_values",
    f"""WITH {_R_TIMED}, k AS (
  SELECT 'hour' AS kind, seq, CAST(event_hour AS VARCHAR) AS part FROM g WHERE event_hour <> 3 OR seq % 2 = 0
  UNION ALL
  SELECT 'name', seq, CASE region WHEN 'view' THEN 'North West' WHEN 'click' THEN 'a/b: 5%, {{c}}' WHEN 'error' THEN NULL ELSE region END
  FROM g WHERE region NOT IN ('view', 'error', 'click') OR seq % 2 = 0)
SELECT * FROM k""",
)
def typed_key_values(spark, folder):
    """Partition values that are whole numbers, missing, or text that a path can't hold as it is; some replaced, some read alone."""
    writer, reader = _lake(spark)
    rows = _timed(spark, folder)
    hours = rows.select("seq", F.col("event_hour").alias("part"))
    writer.write_table("mine.hours", hours, "part")
    writer.write_table("mine.hours", hours.where("part = 3 and seq % 2 = 0"), "part", [3])
    odd = F.when(F.col("region") == "view", "North West").when(F.col("region") == "click", "a/b: 5%, {c}")
    names = rows.select("seq", odd.when(F.col("region") != "error", F.col("region")).alias("part"))
    writer.write_table("mine.names", names, "part")
    replaced = ["North West", "a/b: 5%, {c}", None]
    half = names.where((F.col("part").isin(replaced[:2]) | F.col("part").isNull()) & (F.col("seq") % 2 == 0))
    writer.write_table("mine.names", half, "part", replaced)
    alone = [reader.read_table("mine.names", {"part": part}) for part in replaced]
    rest = reader.read_table("mine.names").where(~F.col("part").isin(replaced[:2]))
    parts = [reader.read_table("mine.hours").withColumn("part", F.col("part").cast("string")), rest, *alone]
    kinds_ = ["hour", *["name"] * 4]
    return union_evolved([p.select(F.lit(k).alias("kind"), "seq", "part") for k, p in zip(kinds_, parts, strict=True)])


@query(
    "delete_rows",
    f"{_STORED} WHERE NOT (region = 'click' AND execution_date = (SELECT MAX(execution_date) FROM r))",
)
def delete_rows(spark, folder):
    table, _, dates = _stored(spark, folder)
    table.delete({"region": "click", "_execution_date": dates[-1]})
    return table.read()


@query(
    "evolved_union",
    f"""WITH {_R}
SELECT seq, tower_id, region, "timestamp", signal_strength, data_volume_mb, NULL::VARCHAR AS vendor,
  execution_date AS _execution_date FROM r WHERE region = 'click'
UNION ALL
SELECT seq, tower_id, region, "timestamp", NULL, data_volume_mb, 'vendor of ' || region, execution_date
FROM r WHERE region <> 'click'""",
)
def evolved_union(spark, folder):
    """Old rows lack a column that later rows add, and hold one that those dropped."""
    table, source = _table(spark, "evolved"), readings(spark, folder)
    table.append(source.where("region = 'click'"))
    later = source.where("region <> 'click'").drop("signal_strength")
    table.append(later.withColumn("vendor", F.concat(F.lit("vendor of "), "region")))
    return table.read()


# -- silver ----------------------------------------------------------------


@query(
    "typed_readings",
    f"""WITH {_typed()} SELECT * EXCLUDE (execution_date), execution_date AS _execution_date,
  make_timestamp("timestamp" * 1000000) AS event_datetime,
  strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d') AS event_date,
  CAST(hour(make_timestamp("timestamp" * 1000000)) AS INTEGER) AS event_hour FROM t""",
)
def typed_readings(spark, folder):
    return clean.add_event_time(clean.type_readings(faulty_readings(spark, folder)))


@query(
    "complete_keys",
    f"""WITH {_typed()} SELECT * EXCLUDE (execution_date), execution_date AS _execution_date FROM t
WHERE tower_id IS NOT NULL AND region IS NOT NULL AND "timestamp" IS NOT NULL""",
)
def complete_keys(spark, folder):
    return clean.type_readings(faulty_readings(spark, folder)).dropna(subset=NATURAL_KEY)


@query(
    "silver_clean",
    f"""WITH {_silver()} SELECT * EXCLUDE (execution_date), execution_date AS _execution_date, 'run' AS _run_id FROM s""",
)
def silver_clean(spark, folder):
    return clean.clean_readings(faulty_readings(spark, folder), "run", order=["seq"])


@query(
    "keep_first",
    f"""WITH {_x()} SELECT * EXCLUDE (execution_date), execution_date AS _execution_date FROM x
QUALIFY row_number() OVER (PARTITION BY execution_date, tower_id, region, "timestamp" ORDER BY seq) = 1""",
)
def keep_first(spark, folder):
    """Duplicates by the raw key, where missing parts compare equal."""
    return dedup.keep_first(faulty_readings(spark, folder), [*NATURAL_KEY, "_execution_date"], ["seq"])


@query(
    "duplicate_counts",
    f"""WITH {_x()} SELECT execution_date, CAST(SUM(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS duplicate_rows
FROM (SELECT execution_date, COUNT(*) AS n FROM x GROUP BY execution_date, tower_id, region, "timestamp")
GROUP BY execution_date""",
)
def duplicate_counts(spark, folder):
    source = faulty_readings(spark, folder).withColumnRenamed("_execution_date", "execution_date")
    return dedup.duplicate_counts(source, "execution_date", NATURAL_KEY)


@query(
    "signal_outliers",
    f"""WITH {_typed()} SELECT * EXCLUDE (execution_date), execution_date AS _execution_date FROM t
WHERE signal_strength < -120 OR signal_strength > -40""",
)
def signal_outliers(spark, folder):
    typed = clean.type_readings(faulty_readings(spark, folder))
    return typed.where(checks.out_of_range(F.col("signal_strength")))


@query(
    "negative_volumes",
    f"""WITH {_typed()} SELECT * EXCLUDE (execution_date), execution_date AS _execution_date FROM t
WHERE data_volume_mb < 0""",
)
def negative_volumes(spark, folder):
    return clean.type_readings(faulty_readings(spark, folder)).where("data_volume_mb < 0")


@query(
    "outside_day",
    f"""WITH {_typed()} SELECT * EXCLUDE (execution_date), execution_date AS _execution_date FROM t
WHERE "timestamp" < epoch(execution_date::TIMESTAMP) OR "timestamp" > epoch(execution_date::TIMESTAMP) + 86399""",
)
def outside_day(spark, folder):
    typed = clean.type_readings(faulty_readings(spark, folder))
    return typed.where(checks.outside_day(F.col("timestamp"), F.col("_execution_date")))


# -- gold ------------------------------------------------------------------


def _timed(spark, folder):
    return clean.add_event_time(readings(spark, folder))


@query("gold_fact_snapshot", f"WITH {_R} {_fact_sql('r')}")
def gold_fact_snapshot(spark, folder):
    return rollups.fact_snapshot(_timed(spark, folder))


@query("gold_hourly", f"WITH {_R_TIMED} {_rollup_sql('g', 'region, event_hour')}")
def gold_hourly(spark, folder):
    return rollups.hourly_rollup(_timed(spark, folder))


@query("gold_daily", f"WITH {_R} {_rollup_sql('r', 'region')}")
def gold_daily(spark, folder):
    return rollups.daily_rollup(_timed(spark, folder))


@query("clean_fact_snapshot", f"WITH {_silver()} {_fact_sql('s')}")
def clean_fact_snapshot(spark, folder):
    return rollups.fact_snapshot(silver_clean(spark, folder))


@query("clean_hourly", f"WITH {_silver()} {_rollup_sql('s', 'region, event_hour')}")
def clean_hourly(spark, folder):
    return rollups.hourly_rollup(silver_clean(spark, folder))


@query("clean_daily", f"WITH {_silver()} {_rollup_sql('s', 'region')}")
def clean_daily(spark, folder):
    return rollups.daily_rollup(silver_clean(spark, folder))


@query("daily_without_volume", f"""WITH {_R}, g AS (
  SELECT * REPLACE (CASE WHEN region <> 'error' THEN data_volume_mb END AS data_volume_mb) FROM r) {_rollup_sql('g', 'region')}""")
def daily_without_volume(spark, folder):
    """One region has no volume at all: its total is zero."""
    rows = readings(spark, folder)
    return rollups.daily_rollup(rows.withColumn("data_volume_mb", F.when(F.col("region") != "error", F.col("data_volume_mb"))))


@query(
    "approximate_towers",
    f"""WITH {_R} SELECT region, execution_date, COUNT(*) AS record_count, TRUE AS within_bound FROM r GROUP BY 1, 2""",
)
def approximate_towers(spark, folder):
    """Towers per region and day from sketches per region and hour, within 5 % of the exact count."""
    rows = _timed(spark, folder)
    stored = _lake(spark)[0]
    stored.write_table("mine.sketches", rollups.tower_sketches(rows), "execution_date")
    about = rollups.approximate_towers(stored.read_table("mine.sketches"), ["region", "execution_date"])
    exact = rollups.daily_rollup(rows).select("region", "execution_date", F.col("tower_count").alias("exact"))
    near = F.abs(F.col("tower_count") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.05 * F.col("exact"))
    return about.join(exact, ["region", "execution_date"]).select("region", "execution_date", "record_count", near.alias("within_bound"))


# -- quality ---------------------------------------------------------------


def _dq_sql(source: str, columns: list[str], only: str | None = None) -> str:
    """The checks as conditional counts with their message texts."""
    extra = ", ".join(f"''{c}''" for c in sorted(set(columns) - set(REQUIRED_COLUMNS)))
    nulls = {c: f'COUNT(*) FILTER ("{c}" IS NULL)' for c in REQUIRED_COLUMNS}
    detail = ", ".join(f"CASE WHEN n_{c} > 0 THEN '{c}=' || n_{c} END" for c in REQUIRED_COLUMNS)
    total = " + ".join(f"n_{c}" for c in REQUIRED_COLUMNS)

    def warn(name: str, n: str, found: str, none: str) -> str:
        return (
            f"SELECT execution_date, '{name}' AS check_name, CASE WHEN {n} > 0 THEN 'warn' ELSE 'pass' END AS status,"
            f" CASE WHEN {n} > 0 THEN {found} ELSE {none} END AS message, CAST({n} AS BIGINT) AS failed_rows FROM v"
        )

    band = "[-120.0, -40.0] dBm."
    parts = {
        "not_empty": "SELECT execution_date, 'not_empty' AS check_name, 'pass' AS status,"
        " n || ' rows found.' AS message, CAST(0 AS BIGINT) AS failed_rows FROM v",
        "schema_columns": "SELECT execution_date, 'schema_columns' AS check_name, 'pass' AS status,"
        f" 'All required columns present. Extra columns (ignored): {{{extra}}}' AS message,"
        " CAST(0 AS BIGINT) AS failed_rows FROM v",
        "null_check": warn(
            "null_check", f"({total})", f"'Nulls found — ' || concat_ws(', ', {detail})", "'No nulls in required columns.'"
        ),
        "signal_range": warn(
            "signal_range", "bad_signal", f"bad_signal || ' rows outside expected range {band}'", f"'All values in {band}'"
        ),
        "data_volume_positive": warn(
            "data_volume_positive",
            "bad_volume",
            "bad_volume || ' rows with negative data_volume_mb.'",
            "'All data_volume_mb values ≥ 0.'",
        ),
        "timestamp_freshness": warn(
            "timestamp_freshness",
            "bad_time",
            "bad_time || ' rows have timestamps outside ' || execution_date || '.'",
            "'All timestamps within ' || execution_date || '.'",
        ),
        "duplicate_rows": warn(
            "duplicate_rows",
            "copies",
            "copies || ' duplicate rows on [''tower_id'', ''region'', ''timestamp''].'",
            "'No duplicate rows.'",
        ),
    }
    chosen = [parts[only]] if only else list(parts.values())
    seconds, volume, signal = (
        f'TRY_CAST("{c}" AS {t})'
        for c, t in (("timestamp", "BIGINT"), ("data_volume_mb", "DOUBLE"), ("signal_strength", "DOUBLE"))
    )
    return f"""v AS (
  SELECT m.*, d.copies FROM (
    SELECT execution_date, COUNT(*) AS n, {", ".join(f"{e} AS n_{c}" for c, e in nulls.items())},
      COUNT(*) FILTER ({signal} < -120 OR {signal} > -40) AS bad_signal,
      COUNT(*) FILTER ({volume} < 0) AS bad_volume,
      COUNT(*) FILTER ({seconds} < epoch(execution_date::TIMESTAMP)
        OR {seconds} > epoch(execution_date::TIMESTAMP) + 86399) AS bad_time
    FROM {source} GROUP BY execution_date) m
  JOIN (
    SELECT execution_date, CAST(SUM(CASE WHEN c > 1 THEN c ELSE 0 END) AS BIGINT) AS copies FROM (
      SELECT execution_date, COUNT(*) AS c FROM {source} GROUP BY execution_date, tower_id, region, "timestamp")
    GROUP BY execution_date) d USING (execution_date)), q AS (
  {" UNION ALL ".join(chosen)})"""


_COUNTS_SQL = " UNION ALL ".join(
    f"""SELECT execution_date, '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT("{c}") AS n_null,
  COUNT(TRY_CAST("{c}" AS BIGINT)) FILTER (NOT contains("{c}", '.')) AS n_int,
  COUNT(TRY_CAST("{c}" AS DOUBLE)) AS n_float,
  COUNT(*) FILTER ("{c}" IN ('True', 'TRUE', 'true', 'False', 'FALSE', 'false')) AS n_bool
FROM x GROUP BY execution_date"""
    for c in REQUIRED_COLUMNS
)
_KIND_SQL = """CASE WHEN n_rows = 0 THEN 'object' WHEN n_null = n_rows THEN 'float64'
  WHEN n_bool = n_rows - n_null THEN CASE WHEN n_null > 0 THEN 'object' ELSE 'bool' END
  WHEN n_int = n_rows THEN 'int64' WHEN n_float = n_rows - n_null THEN 'float64' ELSE 'object' END"""
_EVOLUTION_PARTS = f"""c AS ({_COUNTS_SQL}), m AS (
  SELECT execution_date, string_agg('''' || column_name || ': expected ' || wanted || ', got ' || kind || '''', ', ' ORDER BY place)
    AS found
  FROM (SELECT *, {_KIND_SQL} AS kind,
      CASE column_name WHEN 'tower_id' THEN 0 WHEN 'timestamp' THEN 1 ELSE 2 END AS place,
      CASE column_name WHEN 'signal_strength' THEN 'float' ELSE 'int' END AS wanted FROM c)
  WHERE column_name IN ('tower_id', 'timestamp') AND n_int <> n_rows - n_null
    OR column_name = 'signal_strength' AND n_float <> n_rows - n_null
  GROUP BY execution_date)"""


def _evolution_sql(extra: list[str]) -> str:
    added = ", ".join(f"''{c}''" for c in sorted(extra))
    return f"""SELECT d.execution_date, 'schema_evolution' AS check_name,
  CASE WHEN found IS NULL THEN 'warn' ELSE 'fail' END AS status,
  CASE WHEN found IS NULL THEN 'New columns detected: {{{added}}}. Iceberg schema will be evolved automatically.'
    ELSE 'Column type mismatch detected: [' || found || ']. Pipeline aborted to prevent data corruption.' END
    AS message,
  CAST(0 AS BIGINT) AS failed_rows
FROM (SELECT DISTINCT execution_date FROM x) d LEFT JOIN m USING (execution_date)"""


_X_COLUMNS = [*REQUIRED_COLUMNS, "seq", "_execution_date"]


def _register_check(name: str) -> None:
    @query(f"dq_{name}", f"WITH {_x()}, {_dq_sql('x', _X_COLUMNS, name)} SELECT * FROM q")
    def one_check(spark, folder):
        return checks.run_checks(faulty_readings(spark, folder), checks=[name])


for _name in checks.ALL_CHECKS:
    _register_check(_name)


@query("dq_all", f"WITH {_x()}, {_dq_sql('x', _X_COLUMNS)} SELECT * FROM q")
def dq_all(spark, folder):
    return checks.run_checks(faulty_readings(spark, folder))


@query(
    "dq_all_eight",
    f"""WITH {_x()}, {_dq_sql('x', _X_COLUMNS)}, {_EVOLUTION_PARTS}
SELECT * FROM q UNION ALL BY NAME {_evolution_sql(['seq', '_execution_date'])}""",
)
def dq_all_eight(spark, folder):
    return checks.run_checks(faulty_readings(spark, folder), include_evolution=True)


@query(
    "dq_gate",
    f"""WITH {_x()}, {_dq_sql('x', _X_COLUMNS)}, w AS (
  SELECT execution_date, check_name, status, CASE check_name
    {" ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(checks.ALL_CHECKS))} END AS place FROM q)
SELECT execution_date, bool_or(status = 'fail') AS has_failures,
  '[' || COALESCE(string_agg('''' || check_name || '''', ', ' ORDER BY place) FILTER (status = 'fail'), '') || ']'
    AS failed_checks,
  '[' || COALESCE(string_agg('''' || check_name || '''', ', ' ORDER BY place) FILTER (status = 'warn'), '') || ']'
    AS warned_checks
FROM w GROUP BY execution_date""",
)
def dq_gate(spark, folder):
    return checks.gate_digest(dq_all(spark, folder))


_FAILURES_SQL = """d AS (
  SELECT execution_date, COUNT(*) AS n FROM x GROUP BY 1 UNION ALL
  SELECT strftime(CAST(MAX(execution_date) AS DATE) + 1, '%Y-%m-%d'), 0 FROM x),
c AS (SELECT *, execution_date = (SELECT MIN(execution_date) FROM x) AS lacks FROM d),
q AS (
  SELECT execution_date, 'not_empty' AS check_name, CASE WHEN n = 0 THEN 'fail' ELSE 'pass' END AS status,
    CASE WHEN n = 0 THEN 'File contains zero rows.' ELSE n || ' rows found.' END AS message, CAST(0 AS BIGINT) AS failed_rows
  FROM c
  UNION ALL
  SELECT execution_date, 'schema_columns', CASE WHEN lacks THEN 'fail' ELSE 'pass' END,
    CASE WHEN lacks THEN 'Missing columns: {''region''}' ELSE 'All required columns present.' END, 0
  FROM c)"""


@query("dq_failures", f"WITH {_x()}, {_FAILURES_SQL} SELECT * FROM q")
def dq_failures(spark, folder):
    """The first date's source lacks a column, and the day after the last one has no rows."""
    source = faulty_readings(spark, folder)
    dates = source.select(F.col("_execution_date").alias("execution_date")).distinct()
    ends = source.agg(F.min("_execution_date").alias("first"), F.max("_execution_date").alias("last"))
    spine = dates.unionByName(ends.select(F.date_add(F.to_date("last"), 1).cast("string").alias("execution_date")))
    every, short = (F.array(*(F.lit(c) for c in REQUIRED_COLUMNS if c != lacking)) for lacking in (None, "region"))
    columns = F.when(F.col("first").isNotNull(), short).otherwise(every)
    by_date = spine.join(ends.select("first"), F.col("execution_date") == F.col("first"), "left")
    return checks.run_checks(source, by_date.select("execution_date", columns.alias("columns")), ["not_empty", "schema_columns"])


@query(
    "dq_gate_failures",
    f"""WITH {_x()}, {_FAILURES_SQL}
SELECT execution_date, bool_or(status = 'fail') AS has_failures,
  '[' || COALESCE(string_agg('''' || check_name || '''', ', ' ORDER BY check_name) FILTER (status = 'fail'), '') || ']'
    AS failed_checks, '[]' AS warned_checks
FROM q GROUP BY execution_date""",
)
def dq_gate_failures(spark, folder):
    return checks.gate_digest(dq_failures(spark, folder))


@query("schema_kinds", f"WITH {_x()}, c AS ({_COUNTS_SQL}) SELECT *, {_KIND_SQL} AS kind FROM c")
def schema_kinds(spark, folder):
    return kinds.column_kinds(faulty_readings(spark, folder))


@query("schema_evolution", f"WITH {_x()}, {_EVOLUTION_PARTS} {_evolution_sql(['seq'])}")
def schema_evolution(spark, folder):
    source = faulty_readings(spark, folder)
    columns = F.array(*(F.lit(c) for c in [*REQUIRED_COLUMNS, "seq"]))
    by_date = source.select(F.col("_execution_date").alias("execution_date")).distinct()
    return kinds.schema_evolution(source, by_date.withColumn("columns", columns))


# -- every status and text ---------------------------------------------------

# Clean text readings; every third day holds the faults instead, and other days' sources lack columns.
_DAY = "CAST(right(execution_date, 2) AS INTEGER)"
_VARIED = f"""{_x()}, z AS (
  SELECT seq, CAST(tower_id AS VARCHAR) AS tower_id, region, CAST("timestamp" AS VARCHAR) AS "timestamp",
    CAST(least(signal_strength, -40.5) AS VARCHAR) AS signal_strength, CAST(data_volume_mb AS VARCHAR) AS data_volume_mb,
    execution_date FROM r
), y AS (SELECT * FROM x WHERE {_DAY} % 3 = 0 UNION ALL BY NAME SELECT * FROM z WHERE {_DAY} % 3 <> 0
), dates AS (
  SELECT DISTINCT execution_date, {_DAY} % 6 <> 2 AS metrics, {_DAY} % 6 <> 5 AS keys FROM y
  UNION ALL SELECT 'undated', TRUE, TRUE)"""


def _status_sql() -> str:
    keys, metrics = ["tower_id", "region", "timestamp"], ["signal_strength", "data_volume_mb"]
    nulls = [(c, f'CASE WHEN {"keys" if c in keys else "metrics"} THEN coalesce(n_{c}, 0) ELSE 0 END') for c in REQUIRED_COLUMNS]
    total = " + ".join(e for _, e in nulls)
    detail = ", ".join(f"CASE WHEN {e} > 0 THEN '{c}=' || {e} END" for c, e in nulls)
    lacking = "CASE WHEN NOT keys THEN '{''region'', ''timestamp'', ''tower_id''}' WHEN NOT metrics THEN '{''data_volume_mb'', ''signal_strength''}' END"

    def part(name: str, status: str, message: str, failed: str = "0") -> str:
        return f"SELECT execution_date, '{name}' AS check_name, {status} AS status, {message} AS message, CAST({failed} AS BIGINT) AS failed_rows FROM v"

    def metric(name: str, column: str, has: str, n: str, found: str, none: str) -> str:
        return part(
            name,
            f"CASE WHEN NOT {has} OR {n} > 0 THEN 'warn' ELSE 'pass' END",
            f"CASE WHEN NOT {has} THEN 'Column {column} missing, skipped.' WHEN {n} > 0 THEN {n} || {found} ELSE {none} END",
            f"CASE WHEN {has} THEN {n} ELSE 0 END",
        )

    signal, volume, seconds = (f'TRY_CAST("{c}" AS {t})' for c, t in (("signal_strength", "DOUBLE"), ("data_volume_mb", "DOUBLE"), ("timestamp", "BIGINT")))
    fresh = metric("timestamp_freshness", "timestamp", "keys", "bad_time", "' rows have timestamps outside ' || execution_date || '.'", "'All timestamps within ' || execution_date || '.'")
    undated = "'Could not validate freshness: time data ''undated'' does not match format ''%Y-%m-%d'''"
    parts = [
        part("not_empty", "CASE WHEN n = 0 THEN 'fail' ELSE 'pass' END", "CASE WHEN n = 0 THEN 'File contains zero rows.' ELSE n || ' rows found.' END"),
        part("schema_columns", f"CASE WHEN {lacking} IS NULL THEN 'pass' ELSE 'fail' END", f"coalesce('Missing columns: ' || {lacking}, 'All required columns present.')"),
        part("null_check", f"CASE WHEN {total} > 0 THEN 'warn' ELSE 'pass' END", f"CASE WHEN {total} > 0 THEN 'Nulls found — ' || concat_ws(', ', {detail}) ELSE 'No nulls in required columns.' END", f"({total})"),
        metric("signal_range", "signal_strength", "metrics", "bad_signal", "' rows outside expected range [-120.0, -40.0] dBm.'", "'All values in [-120.0, -40.0] dBm.'"),
        metric("data_volume_positive", "data_volume_mb", "metrics", "bad_volume", "' rows with negative data_volume_mb.'", "'All data_volume_mb values ≥ 0.'"),
        f"SELECT execution_date, check_name, CASE WHEN execution_date = 'undated' THEN 'warn' ELSE status END, CASE WHEN execution_date = 'undated' THEN {undated} ELSE message END, failed_rows FROM ({fresh})",
        part(
            "duplicate_rows",
            "CASE WHEN NOT keys OR copies > 0 THEN 'warn' ELSE 'pass' END",
            "CASE WHEN NOT keys THEN 'Key columns missing, skipped.' WHEN copies > 0 THEN copies || ' duplicate rows on [''tower_id'', ''region'', ''timestamp''].' ELSE 'No duplicate rows.' END",
            "CASE WHEN keys THEN copies ELSE 0 END",
        ),
    ]
    counts = ", ".join(f'COUNT(*) FILTER ("{c}" IS NULL) AS n_{c}' for c in [*keys, *metrics])
    return f"""WITH {_VARIED}, c AS (
  SELECT execution_date, COUNT(*) AS n, {counts},
    COUNT(*) FILTER ({signal} < -120 OR {signal} > -40) AS bad_signal, COUNT(*) FILTER ({volume} < 0) AS bad_volume,
    COUNT(*) FILTER ({seconds} < epoch(execution_date::TIMESTAMP) OR {seconds} > epoch(execution_date::TIMESTAMP) + 86399) AS bad_time
  FROM y GROUP BY execution_date), u AS (
  SELECT execution_date, CAST(SUM(CASE WHEN k > 1 THEN k ELSE 0 END) AS BIGINT) AS copies FROM (
    SELECT execution_date, COUNT(*) AS k FROM y GROUP BY execution_date, tower_id, region, "timestamp") GROUP BY 1), v AS (
  SELECT d.execution_date, metrics, keys, coalesce(n, 0) AS n, {", ".join(f"n_{c}" for c in [*keys, *metrics])},
    coalesce(bad_signal, 0) AS bad_signal, coalesce(bad_volume, 0) AS bad_volume, coalesce(bad_time, 0) AS bad_time,
    coalesce(copies, 0) AS copies
  FROM dates d LEFT JOIN c USING (execution_date) LEFT JOIN u USING (execution_date))
{" UNION ALL ".join(parts)}"""


def _day() -> Column:
    return F.right("execution_date", F.lit(2)).cast("int")


@query("dq_statuses", _status_sql())
def dq_statuses(spark, folder):
    """Clean and faulty days, days whose sources lack metrics or keys, and one that is no date and has no rows."""
    day = F.right("_execution_date", F.lit(2)).cast("int")
    rows = faulty_readings(spark, folder).where(day % 3 == 0).unionByName(text_readings(spark, folder).where(day % 3 != 0))
    dates = rows.select(F.col("_execution_date").alias("execution_date")).distinct()
    every, keys, metrics = (
        F.array(*(F.lit(c) for c in columns))
        for columns in (REQUIRED_COLUMNS, NATURAL_KEY, [c for c in REQUIRED_COLUMNS if c not in NATURAL_KEY])
    )
    columns = F.when(_day() % 6 == 2, keys).when(_day() % 6 == 5, metrics).otherwise(every)
    undated = dates.agg(F.lit("undated").alias("execution_date")).withColumn("columns", every)
    return checks.run_checks(rows, dates.withColumn("columns", columns).unionByName(undated))


_CHANGES = f"""{_R}, d AS (SELECT execution_date, {_DAY} % 4 AS k, COUNT(*) FILTER (seq % 19 = 0) AS bad FROM r GROUP BY 1, 2)"""


@query(
    "schema_changes",
    f"""WITH {_CHANGES}
SELECT execution_date, 'schema_evolution' AS check_name,
  CASE WHEN k = 3 AND bad > 0 THEN 'fail' WHEN k IN (1, 2) THEN 'warn' ELSE 'pass' END AS status,
  CASE WHEN k = 3 AND bad > 0 THEN 'Column type mismatch detected: [''tower_id: expected int, got object'']. Pipeline aborted to prevent data corruption.'
    WHEN k = 1 THEN 'New columns detected: {{''antenna'', ''vendor''}}. Iceberg schema will be evolved automatically.'
    WHEN k = 2 THEN 'Columns no longer in source: {{''region''}}. Existing Iceberg rows will show NULL for these columns.'
    ELSE 'No schema changes detected.' END AS message, CAST(0 AS BIGINT) AS failed_rows
FROM d""",
)
def schema_changes(spark, folder):
    """Days without a change, with new columns, without a column, and with text in a whole-number column."""
    day = F.right("_execution_date", F.lit(2)).cast("int")
    bad = (day % 4 == 3) & (F.col("seq") % 19 == 0)
    rows = text_readings(spark, folder).withColumn("tower_id", F.when(bad, "bad").otherwise(F.col("tower_id")))
    every, more, fewer = (
        F.array(*(F.lit(c) for c in columns))
        for columns in (REQUIRED_COLUMNS, [*REQUIRED_COLUMNS, "vendor", "antenna"], [c for c in REQUIRED_COLUMNS if c != "region"])
    )
    dates = rows.select(F.col("_execution_date").alias("execution_date")).distinct()
    return kinds.schema_evolution(rows, dates.withColumn("columns", F.when(_day() % 4 == 1, more).when(_day() % 4 == 2, fewer).otherwise(every)))


@query(
    "schema_changes_strict",
    f"""WITH {_R}, d AS (
  SELECT execution_date, {_DAY} % 2 = 0 AND COUNT(*) FILTER (seq % 37 = 0) > 0 AS gaps FROM r GROUP BY 1)
SELECT execution_date, 'schema_evolution' AS check_name, CASE WHEN gaps THEN 'fail' ELSE 'pass' END AS status,
  CASE WHEN gaps THEN 'Column type mismatch detected: [''timestamp: expected int, got float64'']. Pipeline aborted to prevent data corruption.'
    ELSE 'No schema changes detected.' END AS message, CAST(0 AS BIGINT) AS failed_rows
FROM d
UNION ALL SELECT '2099-01-01', 'schema_evolution', 'fail',
  'Column type mismatch detected: [''tower_id: expected int, got object'', ''timestamp: expected int, got object'', ''signal_strength: expected float, got object'', ''data_volume_mb: expected float, got object'']. Pipeline aborted to prevent data corruption.', 0""",
)
def schema_changes_strict(spark, folder):
    """As a whole-file reader types columns: gaps make whole numbers floating, a header alone makes all columns text."""
    day = F.right("_execution_date", F.lit(2)).cast("int")
    gap = (day % 2 == 0) & (F.col("seq") % 37 == 0)
    rows = text_readings(spark, folder).withColumn("timestamp", F.when(~gap, F.col("timestamp")))
    dates = rows.select(F.col("_execution_date").alias("execution_date")).distinct()
    dates = dates.unionByName(dates.agg(F.lit("2099-01-01").alias("execution_date")))
    return kinds.schema_evolution(rows, dates.withColumn("columns", F.array(*(F.lit(c) for c in REQUIRED_COLUMNS))), strict=True)


@query(
    "prewrite_gate",
    f"""WITH {_R}, b AS (SELECT execution_date FROM r WHERE seq % 19 = 0 GROUP BY 1), m AS (
  SELECT 'Column type mismatch detected: [''tower_id: expected int, got object'']. Pipeline aborted to prevent data corruption.' AS text)
SELECT 'Schema evolution check failed — aborting bronze write: ' ||
  CASE WHEN COUNT(*) = 1 THEN any_value(text) ELSE string_agg(execution_date || ': ' || text, '; ' ORDER BY execution_date) END AS message,
  CAST(0 AS BIGINT) AS bronze_rows
FROM b, m""",
)
def prewrite_gate(spark, folder):
    """A changed type stops the load before anything is written."""
    source = scratch_path(spark, "drops")
    rows = text_readings(spark, folder).withColumn("tower_id", F.when(F.col("seq") % 19 == 0, "bad").otherwise(F.col("tower_id")))
    write_drops(rows, source)
    engine = Engine(spark, source, scratch_path(spark, "bronze"))
    dates = [r[0] for r in rows.select("_execution_date").distinct().collect()]
    try:
        engine.ingest_bronze(dates, "scan")
        message = None
    except kinds.SchemaEvolutionError as error:
        message = str(error)
    return engine.read_bronze(dates).agg(F.lit(message).alias("message"), F.count("*").alias("bronze_rows"))


@query(
    "dq_log_json",
    f"""WITH {_x("NULL", "NULL")}, {_dq_sql('x', BRONZE_COLUMNS)} SELECT *, 'log' AS run_id FROM q""",
)
def dq_log_json(spark, folder):
    """The quality log as one JSON array per date, read back."""
    source, out = scratch_path(spark, "drops"), scratch_path(spark, "json")
    rows = faulty_readings(spark, folder, bad_tower=None)
    write_drops(rows, source)
    engine = Engine(spark, source, scratch_path(spark, "bronze"), dq_json=out)
    dates = [r[0] for r in rows.select("_execution_date").distinct().collect()]
    engine.ingest_bronze(dates, "log")
    engine.run_dq_checks(dates, "log")
    return spark.read.json(out).withColumn("execution_date", F.col("execution_date").cast("string")).drop("checked_at")


# -- configured rules and volumes ------------------------------------------


@query(
    "configured_silver",
    f"""WITH {_silver()} SELECT seq, tower_id, region, "timestamp", signal_strength, data_volume_mb,
  execution_date AS _execution_date FROM s""",
)
def configured_silver(spark, folder):
    """Typing, complete keys and keep-first as rows of a rule table say."""
    return rules.Rules(rules.reading_rules(spark)).clean(faulty_readings(spark, folder), ["seq"])


_RULED = {
    "tower_id": ("BIGINT", "FALSE"),
    "region": ("VARCHAR", "FALSE"),
    "timestamp": ("BIGINT", "FALSE"),
    "signal_strength": ("DOUBLE", "{v} < -120 OR {v} > -40"),
    "data_volume_mb": ("DOUBLE", "{v} < 0"),
}


def _ruled_sql(column: str, kind: str, outside: str) -> str:
    value = f'TRY_CAST("{column}" AS {kind})'
    return f"""SELECT execution_date, '{column}' AS column_name, COUNT(*) AS n_rows, COUNT(*) FILTER ("{column}" IS NULL) AS n_missing,
  COUNT(*) FILTER ("{column}" IS NOT NULL AND {value} IS NULL) AS n_unreadable,
  COUNT(*) FILTER ({outside.format(v=value)}) AS n_outside FROM x GROUP BY 1"""


@query("configured_counts", f"WITH {_x()} {' UNION ALL '.join(_ruled_sql(c, *k) for c, k in _RULED.items())}")
def configured_counts(spark, folder):
    """Missing, unreadable and out-of-range values per date and column, by the same rule table."""
    return rules.Rules(rules.reading_rules(spark)).counts(faulty_readings(spark, folder))


@query(
    "received_volume",
    f"""WITH {_R}, k AS (
  SELECT execution_date, COUNT(*) AS n FROM r
  WHERE {_DAY} % 10 <> 5 AND ({_DAY} % 7 <> 3 OR seq % 4 = 0) GROUP BY 1), spine AS (
  SELECT strftime(unnest(generate_series(MIN(execution_date)::DATE, MAX(execution_date)::DATE, INTERVAL 1 DAY)), '%Y-%m-%d') AS execution_date FROM r),
v AS (SELECT execution_date, coalesce(n, 0) AS rows FROM spine LEFT JOIN k USING (execution_date)),
w AS (SELECT *, last_value(nullif(rows, 0) IGNORE NULLS) OVER (ORDER BY execution_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_rows FROM v)
SELECT *, CASE WHEN rows > 0 THEN rows / previous_rows END AS change,
  CASE WHEN rows = 0 THEN 'missing' WHEN previous_rows IS NULL THEN 'first' WHEN rows / previous_rows < 0.5 THEN 'drop'
    WHEN rows / previous_rows > 2 THEN 'surge' ELSE 'steady' END AS status
FROM w""",
)
def received_volume(spark, folder):
    """Rows per date next to the last date that had any; some dates are missing, some bring a quarter."""
    day = F.right("_execution_date", F.lit(2)).cast("int")
    rows = readings(spark, folder)
    some = rows.where((day % 10 != 5) & ((day % 7 != 3) | (F.col("seq") % 4 == 0)))
    return volume.received_volume(volume.row_counts(some), calendar.covered_range(rows, "_execution_date"))


# -- ledger ----------------------------------------------------------------

_TABLES_SQL = (
    "(VALUES ('bronze.network_metrics_raw'), ('silver.network_metrics_clean'),"
    " ('gold.fact_tower_daily_snapshot'), ('gold.network_metrics_hourly'), ('gold.network_metrics_daily')) k(table_name)"
)


@query(
    "ledger_open",
    f"""WITH {_WIDE_SPINE} SELECT table_name, execution_date,
  'network_metrics_' || replace(execution_date, '-', '') || '.csv' AS file_name, CAST(1 AS BIGINT) AS seq,
  '2024-02-01 02:00:00' AS event_at, 'running' AS status, NULL::VARCHAR AS error_message,
  NULL::BIGINT AS records_processed, 'run' AS run_id
FROM spine, {_TABLES_SQL}""",
)
def ledger_open(spark, folder):
    at = F.lit("2024-02-01 02:00:00")
    return ledger.opening_events(date_spine(spark, folder), "run", F.lit(1), at)


# Ledger events read off the event table: the run is the day's events of one
# type, the table follows from the user, and the status from the amount.
_EVENTS_SQL = f"""{_R}, ev AS (
  SELECT 'run of ' || execution_date AS run_id, 'table ' || tower_id AS table_name, execution_date,
    'file of ' || region AS file_name, seq, strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d %H:%M:%S')
      AS event_at,
    CASE WHEN region IN ('view', 'click') THEN 'running' WHEN region = 'error' THEN 'fail' ELSE 'success' END AS status,
    CASE WHEN region = 'error' THEN 'error ' || seq END AS error_message,
    CASE WHEN region = 'purchase' THEN seq END AS records_processed
  FROM r), st AS (
  SELECT run_id, table_name, execution_date, arg_max(file_name, seq) AS file_name,
    arg_max(event_at, seq) FILTER (status = 'running') AS start_datetime,
    CASE WHEN arg_max(status, seq) <> 'running' THEN arg_max(event_at, seq) FILTER (status <> 'running') END
      AS finish_datetime,
    arg_max(status, seq) AS status,
    arg_max(error_message, seq) FILTER (error_message IS NOT NULL) AS error_message,
    arg_max(records_processed, seq) FILTER (records_processed IS NOT NULL) AS records_processed
  FROM ev GROUP BY run_id, table_name, execution_date)"""


def _ledger_events(spark, folder):
    region, date = F.col("region"), F.col("_execution_date")
    return readings(spark, folder).select(
        F.concat(F.lit("run of "), date).alias("run_id"),
        F.concat(F.lit("table "), F.col("tower_id").cast("string")).alias("table_name"),
        date.alias("execution_date"),
        F.concat(F.lit("file of "), region).alias("file_name"),
        "seq",
        F.concat_ws(
            " ",
            clock.event_date(F.col("timestamp")),
            F.format_string(
                "%02d:%02d:%02d",
                clock.event_hour(F.col("timestamp")),
                F.floor(F.pmod("timestamp", F.lit(3600)) / 60),
                F.pmod("timestamp", F.lit(60)),
            ),
        ).alias("event_at"),
        F.when(region.isin("view", "click"), "running")
        .when(region == "error", "fail")
        .otherwise("success")
        .alias("status"),
        F.when(region == "error", F.concat(F.lit("error "), F.col("seq").cast("string"))).alias("error_message"),
        F.when(region == "purchase", F.col("seq")).alias("records_processed"),
    )


@query("ledger_state", f"WITH {_EVENTS_SQL} SELECT * FROM st")
def ledger_state(spark, folder):
    return ledger.current_state(_ledger_events(spark, folder))


@query(
    "ledger_close",
    f"""WITH {_EVENTS_SQL} SELECT table_name, execution_date, NULL::VARCHAR AS file_name,
  CAST(9000000000 AS BIGINT) AS seq, '2024-02-01 05:00:00' AS event_at, 'skipped' AS status,
  'No source file for date(s): ' || execution_date AS error_message, NULL::BIGINT AS records_processed, run_id
FROM st WHERE status = 'running'""",
)
def ledger_close(spark, folder):
    note = F.concat(F.lit("No source file for date(s): "), "execution_date")
    state = ledger.current_state(_ledger_events(spark, folder))
    return ledger.closing_events(state, "skipped", F.lit(9_000_000_000), F.lit("2024-02-01 05:00:00"), note)


# -- the whole pipeline ----------------------------------------------------


def _finished_run(spark, folder) -> Engine:
    """Source files with faults, run through every stage over all of their dates."""

    source = scratch_path(spark, "drops")
    write_drops(faulty_readings(spark, folder, bad_tower=None), source)
    ends = readings(spark, folder).agg(
        F.min("_execution_date").alias("first"), F.max("_execution_date").alias("last")
    ).first()
    engine = Engine(spark, source, scratch_path(spark, "lake"))
    engine.run("backfill", ends.last, ends.first, ends.last)
    return engine


_PIPELINE = _silver("NULL", "NULL")  # files hold what means "missing"


@query(
    "backfill_silver",
    f"""WITH {_PIPELINE} SELECT * EXCLUDE (seq, execution_date), execution_date AS _execution_date,
  'network_metrics_' || replace(execution_date, '-', '') || '.csv' AS _source_file, 'backfill' AS _run_id FROM s""",
)
def backfill_silver(spark, folder):
    return _finished_run(spark, folder).read_table("silver.network_metrics_clean").drop("_ingested_at")


@query("backfill_fact_snapshot", f"WITH {_PIPELINE} {_fact_sql('s')}")
def backfill_fact_snapshot(spark, folder):
    return _finished_run(spark, folder).read_table("gold.fact_tower_daily_snapshot")


@query("backfill_hourly", f"WITH {_PIPELINE} {_rollup_sql('s', 'region, event_hour')}")
def backfill_hourly(spark, folder):
    return _finished_run(spark, folder).read_table("gold.network_metrics_hourly")


@query("backfill_daily", f"WITH {_PIPELINE} {_rollup_sql('s', 'region')}")
def backfill_daily(spark, folder):
    return _finished_run(spark, folder).read_table("gold.network_metrics_daily")


@query(
    "backfill_dq_log",
    f"""WITH {_x("NULL", "NULL")}, {_dq_sql('x', BRONZE_COLUMNS)} SELECT *, 'backfill' AS run_id FROM q""",
)
def backfill_dq_log(spark, folder):
    return _finished_run(spark, folder).read_table("pipeline.dq_log").drop("checked_at")


@query(
    "backfill_ledger",
    f"""WITH {_PIPELINE}, n AS (
  SELECT 'bronze.network_metrics_raw' AS table_name, execution_date, COUNT(*) AS n FROM x GROUP BY 2
  UNION ALL SELECT 'silver.network_metrics_clean', execution_date, COUNT(*) FROM s GROUP BY 2
  UNION ALL SELECT 'gold.fact_tower_daily_snapshot', execution_date, COUNT(DISTINCT (tower_id, region)) FROM s GROUP BY 2
  UNION ALL SELECT 'gold.network_metrics_hourly', execution_date, COUNT(DISTINCT (region, event_hour)) FROM s GROUP BY 2
  UNION ALL SELECT 'gold.network_metrics_daily', execution_date, COUNT(DISTINCT region) FROM s GROUP BY 2)
SELECT 'backfill' AS run_id, table_name, execution_date,
  'network_metrics_' || replace(execution_date, '-', '') || '.csv' AS file_name, 'success' AS status,
  NULL::VARCHAR AS error_message, n AS records_processed FROM n""",
)
def backfill_ledger(spark, folder):
    state = _finished_run(spark, folder).ledger.state("backfill")
    return state.drop("start_datetime", "finish_datetime")


# Dates that end in 7 have no source; on odd days the source has a further column, in front.
_GAPS = f"""{_R_TIMED}, u AS (
  SELECT *, CASE WHEN {_DAY} % 2 = 1 THEN 'vendor of ' || region END AS vendor FROM g WHERE {_DAY} % 10 <> 7)"""


def _run_with_gaps(spark, folder) -> Engine:
    source = scratch_path(spark, "drops")
    day = F.right("_execution_date", F.lit(2)).cast("int")
    rows = text_readings(spark, folder).drop("signal_strength").join(readings(spark, folder).select("seq", "signal_strength"), "seq")
    rows = rows.where(day % 10 != 7).withColumn("vendor", F.concat(F.lit("vendor of "), "region"))
    write_drops(rows.where(day % 2 == 0), source)
    write_drops(rows.where(day % 2 == 1), source, ("vendor",))
    ends = readings(spark, folder).agg(F.min("_execution_date").alias("first"), F.max("_execution_date").alias("last")).first()
    engine = Engine(spark, source, scratch_path(spark, "lake"))
    engine.run("gaps", ends.last, ends.first, ends.last)
    return engine


@query(
    "gaps_silver",
    f"""WITH {_GAPS} SELECT tower_id, region, "timestamp", signal_strength, data_volume_mb, vendor, event_hour,
  execution_date AS _execution_date FROM u""",
)
def gaps_silver(spark, folder):
    """A run over dates of which some have no source and some another header."""
    columns = [*REQUIRED_COLUMNS, "vendor", "event_hour", "_execution_date"]
    return _run_with_gaps(spark, folder).read_table("silver.network_metrics_clean").select(*columns)


@query(
    "gaps_ledger",
    f"""WITH {_GAPS}, n AS (
  SELECT 'bronze.network_metrics_raw' AS table_name, execution_date, COUNT(*) AS n FROM u GROUP BY 2
  UNION ALL SELECT 'silver.network_metrics_clean', execution_date, COUNT(*) FROM u GROUP BY 2
  UNION ALL SELECT 'gold.fact_tower_daily_snapshot', execution_date, COUNT(DISTINCT (tower_id, region)) FROM u GROUP BY 2
  UNION ALL SELECT 'gold.network_metrics_hourly', execution_date, COUNT(DISTINCT (region, event_hour)) FROM u GROUP BY 2
  UNION ALL SELECT 'gold.network_metrics_daily', execution_date, COUNT(DISTINCT region) FROM u GROUP BY 2), spine AS (
  SELECT strftime(unnest(generate_series(MIN(execution_date)::DATE, MAX(execution_date)::DATE, INTERVAL 1 DAY)), '%Y-%m-%d') AS execution_date FROM r)
SELECT 'gaps' AS run_id, table_name, execution_date, 'network_metrics_' || replace(execution_date, '-', '') || '.csv' AS file_name,
  CASE WHEN n IS NULL THEN 'skipped' ELSE 'success' END AS status,
  CASE WHEN n IS NULL THEN 'No source file for date(s): [''' || execution_date || ''']' END AS error_message, n AS records_processed
FROM spine CROSS JOIN {_TABLES_SQL} LEFT JOIN n USING (table_name, execution_date)""",
)
def gaps_ledger(spark, folder):
    """The ledger of that run, folded to one file: dates without a source are skipped, the others go on."""
    return _run_with_gaps(spark, folder).ledger.state("gaps").drop("start_datetime", "finish_datetime")


def _with_place(spark, ordered: DataFrame) -> DataFrame:
    """``ordered`` with the place of each row from 1 on; only its partitions' sizes pass one task."""
    path = scratch_path(spark, "ordered")
    ordered.withColumn("id", F.monotonically_increasing_id()).write.parquet(path)  # partition, and row in it
    rows = spark.read.parquet(path).withColumn("part", F.shiftright("id", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.col("start") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.join(F.broadcast(starts), "part").withColumn("place", place).drop("id", "part", "start")


@query(
    "gold_order",
    f"""WITH {_PIPELINE}
SELECT 'fact' AS kind, row_number() OVER (ORDER BY execution_date, tower_id, region) AS place, execution_date,
  tower_id, region, NULL::INTEGER AS event_hour FROM (SELECT DISTINCT execution_date, tower_id, region FROM s)
UNION ALL
SELECT 'hourly', row_number() OVER (ORDER BY execution_date, region, event_hour), execution_date, NULL, region, event_hour
FROM (SELECT DISTINCT execution_date, region, event_hour FROM s)
UNION ALL
SELECT 'daily', row_number() OVER (ORDER BY execution_date, region), execution_date, NULL, region, NULL
FROM (SELECT DISTINCT execution_date, region FROM s)""",
)
def gold_order(spark, folder):
    """The place at which each row of an aggregate comes when it is read for presentation."""
    engine = _finished_run(spark, folder)
    parts = []
    for kind, name in (("fact", FACT), ("hourly", HOURLY), ("daily", DAILY)):
        read = engine.read_gold(name)
        placed = _with_place(spark, read).withColumn("kind", F.lit(kind))
        parts.append(placed.select("kind", "place", "execution_date", *(c for c in ("tower_id", "region", "event_hour") if c in read.columns)))
    return union_evolved(parts)
