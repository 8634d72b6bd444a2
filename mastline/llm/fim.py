"""Fill-in-the-middle order of whole texts, cut at code points through Roaring-style boundary sets.

The bytes at which a text's code points begin, and its end, are a set of whole numbers.
It is kept in containers of 65,536 offsets, each as an array, a bitmap or runs, whichever
is smallest, under their cumulative cardinalities.  The k-th boundary, the byte offset of a cut
after k code points, is selected by a search for its container and a select within it.
Plain ASCII is one run per container, so a cut costs nothing there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mastline.llm.common import mapped, sliced, utf8

SPAN = 1 << 16  # offsets of a container
ARRAY_MOST = 4096  # members up to which an array is smaller than a bitmap
# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
TRANSFORMED, SUFFIX_FIRST = 90, 20  # texts of a hundred that are cut, and of those, with the suffix first


class Runs:
    """Members of a container as runs: first member of each and the members before it."""

    def __init__(self, first: np.ndarray, length: np.ndarray):
        self.first = first.astype(np.uint16)
        self.before = np.concatenate([[0], np.cumsum(length)])

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


class Array:
    """Members of a container, in order."""

    def __init__(self, members: np.ndarray):
        self.members = members.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.members[k])


class Bitmap:
    """Members of a container as bits, with the members before each byte."""

    def __init__(self, on: np.ndarray):
        self.bits = np.packbits(on, bitorder="little")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)])

    def select(self, k: int) -> int:
        byte = int(np.searchsorted(self.before, k, "right")) - 1
        inside = np.flatnonzero(np.unpackbits(self.bits[byte : byte + 1], bitorder="little"))
        return 8 * byte + int(inside[k - int(self.before[byte])])


class Boundaries:
    """The byte offsets of a UTF-8 text at which a code point begins, and its end."""

    def __init__(self, raw: np.ndarray):
        on = np.append((raw & 0xC0) != 0x80, True)
        self.containers = []
        sizes = []
        for at in range(0, len(on), SPAN):
            kind, n = container(on[at : at + SPAN])
            self.containers.append(kind)
            sizes.append(n)
        self.before = np.concatenate([[0], np.cumsum(sizes)])
        self.size = int(self.before[-1])

    def select(self, k: int) -> int:
        """The byte offset after ``k`` code points."""
        c = int(np.searchsorted(self.before, k, "right")) - 1
        return c * SPAN + self.containers[c].select(k - int(self.before[c]))


def container(on: np.ndarray) -> tuple[Runs | Array | Bitmap, int]:
    """The smallest container for the set offsets, and their number."""
    n = int(np.count_nonzero(on))
    edge = np.flatnonzero(on[1:] != on[:-1]) + 1
    starts = edge[on[edge]]
    if on[0]:
        starts = np.append(0, starts)
    runs = 4 * len(starts)
    if runs <= min(2 * n, SPAN // 8):
        ends = edge[~on[edge]]
        ends = np.append(ends, len(on)) if on[-1] else ends
        return Runs(starts, ends - starts), n
    return (Array(np.flatnonzero(on)), n) if n <= ARRAY_MOST else (Bitmap(on), n)


class _Ascii:
    """Boundaries of a text without longer code points: the one run in closed form."""

    def __init__(self, length: int):
        self.size = length + 1

    def select(self, k: int) -> int:
        return k


def boundaries(raw: np.ndarray) -> Boundaries | _Ascii:
    return Boundaries(raw) if len(raw) and raw.max() > 127 else _Ascii(len(raw))


def drawn(doc_id: int | str | None, seed: int = 1) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document: of the SHA-256 of seed, colon and doc_id (null: nothing after the colon)."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(h[i : i + 4], "big") for i in (0, 4, 8, 12))


def rearranged(raw: bytes, edge: Boundaries | _Ascii, h: tuple[int, int, int, int]) -> tuple[int, str, int | None, int | None, bytes]:
    """Code points, form, code points of prefix and middle, and the output of one text."""
    n = edge.size - 1
    if not raw or PREFIX in raw or SUFFIX in raw or MIDDLE in raw or h[2] % 100 >= TRANSFORMED:
        return n, PLAIN, None, None, raw
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = edge.select(low), edge.select(high)
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    if h[3] % 100 < SUFFIX_FIRST:
        return n, SPM, low, high - low, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, PSM, low, high - low, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs`` (doc_id, text).

    Both cuts follow from ``seed`` and doc_id alone, so reruns agree and rows that repeat a
    doc_id and text come out alike.  Null counts as empty; an empty text and one that holds
    a mark stay plain, with null counts.  Rows without doc_id share one draw.  Texts of any
    length are cut whole; other columns, whatever their names, are not read.  An empty table
    gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, data, bounds in sliced(*utf8(b.column(1)), 1 << 22):
                ids, at = b.column(0).slice(first, last - first), bounds.tolist()
                whole = data.tobytes()
                rows = [
                    rearranged(whole[s:e], boundaries(data[s:e]), drawn(i, seed))
                    for i, s, e in zip(ids.to_pylist(), at[:-1], at[1:], strict=True)
                ]
                n, form, low, middle, out = zip(*rows, strict=True)
                cols = [ids, pa.array(n, pa.int64()), pa.array(form), pa.array(low, pa.int64()), pa.array(middle, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return mapped(docs.select("doc_id", "text"), run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from."""
    p, s, m = (x.decode() for x in (PREFIX, SUFFIX, MIDDLE))

    def parts(second: str) -> tuple[Column, Column, Column]:
        """What stands after the first mark, after ``second`` and after the mark of the middle."""
        body = F.substring(output, F.lit(len(p) + 1), F.length(output))
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.length(one) + len(second) + 1, F.length(body))
        two = F.substring_index(rest, m, 1)
        return one, two, F.substring(rest, F.length(two) + len(m) + 1, F.length(rest))

    prefix, suffix, middle = parts(s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(p)
    return F.when(form == PSM, psm).when(form == SPM, F.concat(prefix, middle, suffix)).otherwise(output)


def fim_report(docs: DataFrame, seed: int = 1) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256): ``fill_in_middle`` with digests for its texts."""
    rows = fill_in_middle(docs, seed)
    digest = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(restored(F.col("output"), F.col("form")), 256)}
    return rows.withColumns(digest).drop("output")
