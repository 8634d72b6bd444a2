"""Written intermediate tables, size-checked joins and NumPy views of Arrow text."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What one broadcast may hold; larger sides are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
MARKED_ROWS = 250_000  # the same for rows with a digest
# Bytes of text worked on at once; one longer text is worked on alone.
SLICE_BYTES = 1 << 18

# The white space of every word rule here, [\x20\x09-\x0D].
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only on a local master that names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="mastline-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: read many times, computed once, no lineage behind it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has few rows.  ``df`` should be a written table or cheap to count."""
    return F.broadcast(df) if df.count() <= rows else df


def text_mark() -> Column:
    """A digest of the text that names a row together with its doc_id; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a struct (doc_id, mark) as doc_id, so that a decision names its row's text too."""
    return docs.select(F.struct("doc_id", text_mark().alias("mark")).alias("doc_id"), "text")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows whose doc_id (null is a value) and text are in the written table ``gone`` (doc_id, mark)."""
    gone = sized(gone.select(F.col("doc_id").alias("__gone"), F.col("mark").alias("__mark")).distinct(), MARKED_ROWS)
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["__gone"]) & (text_mark() == gone["__mark"]), "left_anti")


def only(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """``docs`` less what the written table ``decided`` (doc_id, mark, stays) rejects; of equal rows that stay, one.

    Rows that are not in ``decided`` stay.  Equal are rows of one doc_id and text; the first
    by the other columns' JSON stays.
    """
    gone = written(decided.where(~F.col("stays")).select("doc_id", "mark").distinct(), "gone")
    twice = decided.where("stays").groupBy("doc_id", "mark").agg(F.count("*").alias("n")).where("n > 1")
    twice = written(twice.select("doc_id", "mark"), "twice")
    rest = without(docs, gone)
    if twice.isEmpty():
        return rest
    few = sized(twice.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")), MARKED_ROWS)
    same = rest.withColumn("__own", text_mark())
    same = same.join(few, same["doc_id"].eqNullSafe(few["__id"]) & (same["__own"] == few["__mark"]), "left_semi")
    order = Window.partitionBy("doc_id", "__own").orderBy(F.to_json(F.struct(*docs.columns)))
    first = same.withColumn("__row", F.row_number().over(order)).where("__row = 1").select(*docs.columns)
    return without(rest, twice).unionByName(first)


def release() -> None:
    """Hands freed memory back to the system; Python workers live on between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose worker keeps no memory after its task."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return df.mapInArrow(tidy, schema)


# ---- Arrow text as NumPy bytes ----------------------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a text column; null counts as empty."""
    column = pc.fill_null(column, "")
    n, at = len(column), column.offset
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind, n + 1, at * kind().itemsize).astype(np.int64) if n else np.zeros(1, np.int64)
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8, bounds[-1] - bounds[0], bounds[0]), bounds - bounds[0]


def sliced(data: np.ndarray, bounds: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: first, last + 1, their bytes, their offsets."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        yield first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def byte_table(keep: bytes | None = None, lower: bool = False) -> np.ndarray:
    """What each byte becomes; 0 parts words.  ``keep``: the only ASCII bytes that words hold, else all but white space."""
    table = np.arange(256, dtype=np.uint8)
    if keep is None:
        table[0] = 9  # a NUL is part of a word; a tab never is
        table[list(SPACES)] = 0
    else:
        ascii_kept = np.zeros(128, bool)
        ascii_kept[list(keep)] = True
        table[:128][~ascii_kept] = 0
    if lower:
        table[65:91] = np.where(table[65:91], table[65:91] + 32, 0)
    return table


class Words:
    """The words of many texts in one array: bytes with one separator after each word.

    ``doc``: text of each word; ``start`` (n + 1): where each word begins in ``text``.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, table: np.ndarray):
        kept = table[data]
        on = kept != 0
        begins = on.copy()
        begins[1:] &= ~on[:-1]
        edges = bounds[:-1][bounds[:-1] < bounds[1:]]  # a text's first byte begins a word even if the last text ended in one
        begins[edges] |= on[edges]
        at = np.flatnonzero(begins)
        self.doc = np.searchsorted(bounds, at, "right") - 1
        here = np.flatnonzero(on)
        word = np.cumsum(begins, dtype=np.int64)[here] - 1
        n = len(at)
        self.text = np.full(len(here) + n, 32, np.uint8)
        self.text[np.arange(len(here)) + word] = kept[here]
        lengths = np.bincount(word, minlength=n) if n else np.zeros(0, np.int64)
        self.length = lengths
        self.start = np.concatenate([[0], np.cumsum(lengths + 1)]).astype(np.int64)
        self.n = n
        self.per_doc = np.bincount(self.doc, minlength=len(bounds) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.per_doc)])


_MIX = np.random.RandomState(20240711)
_BYTE = _MIX.randint(0, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand and kept per worker."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 2 * SLICE_BYTES + 64)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = (both[0], both[1])
        if n <= 4 * SLICE_BYTES:
            _POWERS[base] = have
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Hashes of any stretch of a byte array, each in constant time from prefix sums."""

    def __init__(self, text: np.ndarray, which: int = 0):
        up, self.down = _powers(_BASES[which], len(text) + 1)
        self.sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(_BYTE[text] * up[: len(text)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
