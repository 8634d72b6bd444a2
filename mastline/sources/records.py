"""CSV records whose quoted fields hold line breaks, from files that are read in splits all the same.

Where a line ends within a quoted field depends on whether it began in one.  So each line, and by
composition each split, maps the state it begins in (outside or inside a quoted field) to the
state it ends in.  A first pass over the files works out one such map per split; composed in the
order of a file they give the state each split begins in.  A second pass cuts every split at its
true record ends.  Only the pieces of records that cross a split's edge, two a split at most, are
put together by a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A quote opens a field only where the field begins, and ends it unless doubled.
_QUOTED = r'"(?:[^"]|"")*+"'
_FIELD = rf"(?:{_QUOTED}[^,]*+|[^\",][^,]*+|)"
_OPEN = r'"(?:[^"]|"")*+'  # a field that is not ended
# Of a line that begins outside, and inside a quoted field: whether it ends inside one.
ENDS_OPEN = rf"^(?:{_FIELD},)*+{_OPEN}$"
STAYS_OPEN = rf'^(?:[^"]|"")*+$|^(?:[^"]|"")*+"[^,]*+,(?:{_FIELD},)*+{_OPEN}$'



def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    # Only line feeds part lines here: what else a quoted field holds stays as it is.
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def broken_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file): those with a line that, begun outside, ends within a quoted field; lines without a quote are only scanned."""
    hit = F.contains("value", F.lit('"')) & F.rlike("value", F.lit(f"(?s){ENDS_OPEN}"))
    return _lines(spark, paths).where(hit).select("file").distinct()


def split_states(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, inside): whether each split of the files begins within a quoted field."""
    lines = _lines(spark, paths).select(
        "file",
        "block",
        F.rlike("value", F.lit(f"(?s){ENDS_OPEN}")).alias("out_to"),
        F.rlike("value", F.lit(f"(?s){STAYS_OPEN}")).alias("in_to"),
    )

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The composed map of every split; a task reads a split's lines in order."""
        at, ends = None, (False, True)
        for b in batches:
            for file, block, out_to, in_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (file, block) != at:
                    if at:
                        yield _maps(at, ends)
                    at, ends = (file, block), (False, True)
                ends = tuple(in_to if e else out_to for e in ends)
        if at:
            yield _maps(at, ends)

    maps = lines.mapInArrow(fold, "file string, block long, out_to boolean, in_to boolean")
    # A split that ends the same either way sets the state; one that turns it round counts from there.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("out_to") == F.col("in_to")
    turns = F.sum(F.when(F.col("out_to") & ~F.col("in_to"), 1).otherwise(0)).over(before)
    upto = Window.partitionBy("file").orderBy("block")
    own = F.sum(F.when(F.col("out_to") & ~F.col("in_to"), 1).otherwise(0)).over(upto)
    mark = F.when(fixed, F.struct(F.col("out_to").alias("state"), own.alias("turns")))
    rows = maps.withColumns({"turns": F.coalesce(turns, F.lit(0)), "mark": mark})
    rows = rows.withColumn("last", F.last("mark", ignorenulls=True).over(before))
    since = F.col("turns") - F.coalesce("last.turns", F.lit(0))
    inside = F.coalesce("last.state", F.lit(False)) != (F.pmod(since, F.lit(2)) == 1)
    return rows.select("file", "block", inside.alias("inside"))


def _maps(at: tuple[str, int], ends: tuple[bool, bool]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"file": [at[0]], "block": [at[1]], "out_to": [ends[0]], "in_to": [ends[1]]})


def pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, row, text, begins, ends): records, and pieces of those that cross a split's edge, in order.

    One row per split of ``paths`` passes the driver.
    """
    known = {(r.file, r.block): r.inside for r in split_states(spark, paths).collect()}
    sent = spark.sparkContext.broadcast(known)
    lines = _lines(spark, paths).select(
        "value",
        "file",
        "block",
        F.rlike("value", F.lit(f"(?s){ENDS_OPEN}")),
        F.rlike("value", F.lit(f"(?s){STAYS_OPEN}")),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, begins, row, held = None, False, True, 0, []
        out: dict[str, list] = {k: [] for k in ("file", "block", "row", "text", "begins", "ends")}

        def put(ends: bool) -> None:
            for k, v in zip(out, (*at, row, "\n".join(held), begins, ends), strict=True):
                out[k].append(v)

        for b in batches:
            for value, file, block, out_to, in_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (file, block) != at:
                    if held:
                        put(False)
                    # A split unknown to the first pass, whose edges were others, has no state: that stops the job.
                    at, inside = (file, block), sent.value[file, block]
                    begins, row, held = not inside, 0, []
                if not inside and not held and not value.strip():
                    continue
                held.append(value)
                inside = in_to if inside else out_to
                if not inside:
                    put(True)
                    begins, row, held = True, row + 1, []
            yield _batch(out)
        if held:
            put(False)
            yield _batch(out)

    return lines.mapInArrow(cut, "file string, block long, row long, text string, begins boolean, ends boolean")


def _batch(out: dict[str, list]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    made = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))
    for v in out.values():
        v.clear()
    return made


def scan(spark: SparkSession, head: tuple[str, ...], paths: list[str], malformed: str) -> DataFrame:
    """The records of ``paths`` as text columns, their raw text in ``malformed`` where the number of fields is another, and their place.

    Blank lines outside of quotes are left out; each file's first record has to be the header, and
    a quoted field without an end stops the scan.
    """
    parts = pieces(spark, paths)
    whole = parts.where("begins and ends").select("file", "block", "row", "text")
    order = Window.partitionBy("file").orderBy("block", "row")
    edges = parts.where("not (begins and ends)").withColumn("record", F.sum(F.col("begins").cast("int")).over(order))
    joined = edges.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "row", "text"))).alias("texts"), F.bool_or("ends").alias("ended"))
    endless = F.concat(F.lit("a quoted field without an end in "), "file")
    joined = joined.where(F.when(F.col("ended"), True).otherwise(F.raise_error(endless).cast("boolean")))
    at = F.element_at("texts", 1)
    joined = joined.select("file", at["block"].alias("block"), at["row"].alias("row"), F.array_join("texts.text", "\n").alias("text"))
    rows = whole.unionByName(joined).withColumn("text", F.regexp_replace("text", "\r$", ""))

    names = [f"c{i}" for i in range(len(head))]
    shape = ", ".join(f"{c} string" for c in [*names, "other"])
    cells = F.from_csv(F.regexp_replace("text", "^\ufeff", ""), shape, {"escape": '"', "columnNameOfCorruptRecord": "other"})
    rows = rows.withColumn("x", cells)
    is_head = F.lit(True)
    for i, name in enumerate(head):
        cell = F.coalesce(f"x.c{i}", F.lit(""))
        same = (cell == name) | (F.concat(cell, F.lit(str(i))) == name)
        is_head &= same | (cell == "") if name == f"_c{i}" else same
    wrong = F.concat(F.lit("another header in "), "file", F.lit(": "), "text")
    first = (F.col("block") == 0) & (F.col("row") == 0)
    rows = rows.where(F.when(~first, True).when(is_head, False).otherwise(F.raise_error(wrong).cast("boolean")))
    return rows.select(
        *(F.col(f"x.c{i}").alias(name) for i, name in enumerate(head)),
        F.col("x.other").alias(malformed),
        F.col("file").alias("__file"),
        F.col("block").alias("__block"),
        F.col("row").alias("__row"),
    )
