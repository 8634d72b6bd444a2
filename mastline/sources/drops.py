"""Daily source files: what has arrived, and one scan over all of it."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mastline.constants import FILE_PREFIX, FILE_SUFFIX, NA_TOKENS
from mastline.functions import clock
from mastline.schemas import ROW_SEQ
from mastline.sinks.files import Folder
from mastline.sinks.tables import union_evolved
from mastline.sources import records

_STAMP_LENGTH = 8 + len(FILE_SUFFIX)
DEPTH = 3  # folders below the source folder in which a date's file may lie
GROUP_BYTES = 1 << 39  # of broken drops read together: one row per split of theirs passes the driver

# Raw text of a row whose field count differs from its header's.
_MALFORMED = "__malformed"
_END = "\u0001end"

# What a scan adds to the source columns.
_SCAN_TAIL = T.StructType(
    [
        T.StructField("_source_file", T.StringType()),
        T.StructField("_execution_date", T.StringType()),
        T.StructField("_row_seq", ROW_SEQ),
    ]
)


@dataclass(frozen=True)
class Drop:
    """One day's source: a file, or a folder of part files, named for the date."""

    execution_date: str
    path: str
    bytes: int


def dated_root(path: Column) -> Column:
    """The file or folder named for a date that a path is or lies in; empty if there is none."""
    return F.regexp_extract(path, rf"^(.*{FILE_PREFIX}\d{{8}}\{FILE_SUFFIX})(/|$)", 1)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per date that has a source, without reading any content.

    A date with two sources stops the query: neither is chosen over the other.
    """
    two = F.concat(F.lit("two sources for "), F.col("execution_date"), F.lit(": "), F.concat_ws(", ", "roots"))
    one = F.when(F.size("roots") > 1, F.raise_error(two)).otherwise(F.element_at("roots", 1))
    return _sources(spark, folder).select("execution_date", one.alias("path"), "bytes")


def _sources(spark: SparkSession, folder: str) -> DataFrame:
    """Each date's sources, sorted, and their bytes."""
    empty = "execution_date string, roots array<string>, bytes bigint"
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"*{FILE_SUFFIX}")
            .load(folder)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], empty)
        raise
    root = dated_root(F.col("path"))
    date = clock.date_in_path(F.col("root"))
    return (
        files.select("path", "length", root.alias("root"))
        .where((F.col("root") != "") & F.try_to_date(date, "yyyy-MM-dd").isNotNull())
        .groupBy(date.alias("execution_date"))
        .agg(F.sort_array(F.collect_set("root")).alias("roots"), F.sum("length").alias("bytes"))
    )


def arrived(spine: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Requested dates that have a source."""
    return spine.join(arrivals, "execution_date", "left_semi")


def missing(spine: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Requested dates without a source."""
    return spine.join(arrivals, "execution_date", "left_anti")


def availability(spark: SparkSession, spine: DataFrame, folder: str) -> tuple[list[Drop], list[str]]:
    """Found drops and missing dates; one row per requested date comes to the driver.

    Only what is named for a requested date is looked into, up to ``DEPTH`` folders down.
    """
    dates = sorted(r[0] for r in spine.select("execution_date").distinct().collect())
    if not dates:
        return [], []
    root = Folder(spark, folder)
    names = "{*=,}{" + ",".join(map(clock.file_name, dates)) + "}"  # also as the value of a partition column
    sources: dict[str, dict[str, int]] = {}
    for depth in range(DEPTH + 1):
        for path, size, is_folder in root.matching("*/" * depth + names):
            above = path.split("/")[:-1]
            if not any(p.endswith(FILE_SUFFIX) or p.startswith(("_", ".")) for p in above):
                held = sum(root.sizes(path).values()) if is_folder else size
                sources.setdefault(path.rsplit("/", 1)[-1].rsplit("=", 1)[-1], {})[path] = held
    by_date = {d: sources.get(clock.file_name(d), {}) for d in dates}
    twice = {d: sorted(s) for d, s in by_date.items() if len(s) > 1}
    if twice:
        raise ValueError(f"Two sources for one date: {twice}")
    found = [Drop(d, f"{root.root}/{p}", n) for d, s in by_date.items() for p, n in s.items()]
    return found, [d for d, s in by_date.items() if not s]


def headers(spark: SparkSession, drops: list[Drop]) -> dict[str, list[str]]:
    """Column names of each date's source, from its first line only."""

    def names(drop: Drop) -> list[str]:
        if not drop.bytes:
            return []
        above, _, name = drop.path.rpartition("/")
        root = Folder(spark, above)
        lines = (root.first_line(f) for f, size in root.sizes(name).items() if size)
        return _names(next(filter(None, lines), ""))

    if not drops:
        return {}
    # Threads only overlap the latency of opening a file.
    with ThreadPoolExecutor(min(16, len(drops))) as pool:
        return dict(zip((d.execution_date for d in drops), pool.map(names, drops)))


def _names(line: str) -> list[str]:
    """Column names of a header line; as Spark names them where they are empty or repeat."""
    cells = next(csv.reader([line]), [])
    lower = [c.lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if lower.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


def _reader(spark: SparkSession):
    # Doubled quotes are the escape; a header that does not match the schema
    # given must stop the job, since CSV columns bind by position.
    return spark.read.options(header=True, escape='"', enforceSchema=False)


def missing_to_null(c: Column) -> Column:
    """NULL where the text is one of the missing-value tokens."""
    return F.when(~c.isin(NA_TOKENS), c)


def scan(
    spark: SparkSession, drops: list[Drop], columns: dict[str, list[str]], broken: set[str] | None = None
) -> DataFrame:
    """All drops as text columns plus ``_source_file``, ``_execution_date``, ``_row_seq``.

    Files with the same header are read together; the few distinct headers are
    then united by name.  A file without any line has no header and no rows.  ``broken`` names
    the drops in which a quoted field holds a line break (by ``broken_drops`` if not given);
    they are read by another way, split all the same.
    """
    if broken is None:
        broken = broken_drops(spark, drops)
    groups: dict[tuple, list[str]] = {}
    seen = 0  # bytes of broken drops so far
    for drop in drops:
        head = tuple(columns[drop.execution_date])
        if drop.path in broken:
            seen += drop.bytes
            groups.setdefault((seen // GROUP_BYTES, head), []).append(drop.path)
        else:
            groups.setdefault((None, head), []).append(drop.path)
    frames = [
        _placed(_lines(spark, head, paths) if group is None else records.scan(spark, head, paths, _MALFORMED), head)
        for (group, head), paths in groups.items()
        if head
    ]
    if not frames:
        return spark.createDataFrame([], _SCAN_TAIL)
    return union_evolved(frames)


def broken_drops(spark: SparkSession, drops: list[Drop]) -> set[str]:
    """Paths of the drops with a line that ends within a quoted field; one scan of the lines that hold a quote."""
    paths = [d.path for d in drops if d.bytes]
    if not paths:
        return set()
    roots = records.broken_files(spark, paths).select(dated_root(F.col("file")).alias("root")).distinct().collect()
    names = {r.root.rsplit("/", 1)[-1] for r in roots}  # one source per date, so a name is a source
    return {p for p in paths if p.rsplit("/", 1)[-1] in names}


def _lines(spark: SparkSession, head: tuple[str, ...], paths: list[str]) -> DataFrame:
    """One record per line, by Spark's own reader, with its place."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*head, _MALFORMED)])
    # Scan facts first: later operators may regroup rows.
    raw = _reader(spark).schema(schema).option("columnNameOfCorruptRecord", _MALFORMED).csv(paths)
    return raw.select(
        *(F.col(f"`{c}`") for c in head),
        _MALFORMED,
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
    )


def _placed(raw: DataFrame, head: tuple[str, ...]) -> DataFrame:
    """Records with their place as the source's columns, name, date and row order."""
    placed = raw.withColumns({c: missing_to_null(F.col(f"`{c}`")) for c in head})
    stamp = F.substring_index("__file", FILE_PREFIX, -1)
    single = F.length(stamp) == _STAMP_LENGTH
    return placed.select(
        *(F.col(f"`{c}`") for c in head),
        F.concat(F.lit(FILE_PREFIX), F.left(stamp, F.lit(_STAMP_LENGTH))).alias("_source_file"),
        # On the one column every reader of a scan uses, so no row goes unchecked.
        F.when(_has_surplus(len(head)), F.raise_error(_surplus_text()))
        .otherwise(clock.date_in_path(F.col("__file")))
        .alias("_execution_date"),
        F.struct(
            F.when(single, "").otherwise(F.substring_index("__file", "/", -1)).alias("part"),
            F.col("__block").alias("block"),
            F.col("__row").alias("row"),
        ).alias("_row_seq"),
    )


def _has_surplus(width: int) -> Column:
    """Whether a row has more fields than its header; a shorter row is only padded."""
    columns = [f"c{i}" for i in range(width)]
    # A mark after the last field lies within the header's width only if the row is shorter;
    # empty surplus fields read as NULL, so they can't be told by their values.
    marked = F.concat(F.col(_MALFORMED), F.lit("," + _END))
    fields = F.from_csv(marked, ", ".join(f"{c} string" for c in columns), {"escape": '"'})
    shorter = F.exists(F.array(*[fields[c] for c in columns]), lambda x: x.eqNullSafe(F.lit(_END)))
    return F.col(_MALFORMED).isNotNull() & ~shorter


def _surplus_text() -> Column:
    return F.concat(F.col("__file"), F.lit(": a row has more fields than its header: "), F.col(_MALFORMED))
