"""Exact copies by digest, with frequent digests taken out map-side.

Misra-Gries counters find digests that may be frequent; a second look over the small
digest table verifies their counts and winners.  These few rows are broadcast, so copies
of a frequent text never meet in one task.  The rest, of which no digest is
frequent, is shuffled by digest.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mastline.llm.common import SPACES, keyed, mapped, only, written

# Counters of a task and rows of the broadcast: a digest with over 1/(k + 1) of all rows is always among them.
COUNTERS = 1024


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest binary, points) of ``docs`` (doc_id, text): SHA-256 of the text less all ``[\\x20\\x09-\\x0D]``, and the text's code points."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pc.fill_null(b.column(1), "")
            points = pc.cast(pc.utf8_length(text), pa.int64())
            raw = pc.cast(text, pa.binary())
            sha = [hashlib.sha256(x.as_py().translate(None, SPACES)).digest() for x in raw]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sha, pa.binary()), points], ["doc_id", "digest", "points"])

    return mapped(docs.select("doc_id", "text"), run, f"doc_id {kind}, digest binary, points long")


def misra_gries(counts: Counter, more: Counter, k: int) -> Counter:
    """Two summaries as one of at most ``k`` counters; a count is too low by at most rows / (k + 1)."""
    both = counts + more
    if len(both) <= k:
        return both
    cut = sorted(both.values(), reverse=True)[k]
    return Counter({x: n - cut for x, n in both.items() if n > cut})


def frequent(table: DataFrame, k: int = COUNTERS) -> DataFrame:
    """At most ``k`` digests, among them all that hold over 1/(k + 1) of the rows.

    One summary per task; summaries are added up by digest, which keeps the error bound.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            held = misra_gries(held, Counter(b.column(0).to_pylist()), k)
        some = list(held.items())
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in some], pa.binary()), pa.array([n for _, n in some], pa.int64())], ["digest", "n"])

    parts = mapped(table.select("digest"), run, "digest binary, n long")
    return parts.groupBy("digest").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "digest").limit(k).select("digest")


def exact_groups(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every row of ``docs`` (doc_id, text).

    Of equal texts the row with the most code points stays, then the smallest doc_id (null
    last).  Null counts as empty text.  Rows that repeat a doc_id count in group_size
    and share its fate.  An empty table gives no rows.
    """
    out = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"]
    return _groups(digests(docs).withColumn("mark", F.lit(None).cast("binary")), k).select(*out)


def _groups(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` (doc_id, digest, points, mark) with group_size, and the staying row of their group in ``best``, its doc_id as keep_id."""
    table = written(rows, "digests")
    best = F.max(F.struct("points", (F.col("doc_id").isNotNull()).alias("known"), (-F.col("doc_id")).alias("low"), "mark"))
    keep = -F.col("best.low")

    candidates = F.broadcast(frequent(table, k))  # k rows at most
    heavy = table.join(candidates, "digest", "left_semi").groupBy("digest").agg(F.count("*").alias("group_size"), best.alias("best"))
    heavy = written(heavy.withColumn("keep_id", keep), "heavy")  # k rows at most
    mapside = table.join(F.broadcast(heavy), "digest")

    same = Window.partitionBy("digest")
    light = table.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    light = light.withColumns({"group_size": F.count("*").over(same), "best": best.over(same)}).withColumn("keep_id", keep)
    return mapside.unionByName(light)


def drop_copies(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """``docs`` with one row of each group of equal texts; columns as they are.

    It is the row that ``exact_groups`` keeps.  Where several rows of a group have its doc_id,
    the one with the most code points stays, then the one with the largest digest of
    the text as it is, then the first by the other columns.
    """
    rows = digests(keyed(docs)).select("doc_id.*", "digest", "points")
    found = _groups(rows, k).where("group_size > 1")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("best.points")) & (F.col("mark") == F.col("best.mark"))
    return only(docs, written(found.select("doc_id", "mark", stays.alias("stays")), "copies"))


def exact_report(docs: DataFrame) -> DataFrame:
    """The groups with the digest as lowercase hex."""
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
