"""SimHash links: fingerprints, and a grid range-join over their segments' bit counts.

A fingerprint is cut into segments of two bits.  The counts of one-bits per segment embed it in
a grid in which the Manhattan distance never exceeds the Hamming distance, so fingerprints
within r bits are within r there.  Segments are dealt to r + k groups.  At most r groups can
differ, so two such fingerprints agree in all counts of some k groups: they meet in the cell
named by those k groups and their counts.  A cell is joined by range: counts of the two halves
may differ by r in sum, and only then is the exact distance taken.  k follows from the number of
fingerprints, so cells do not grow with the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastline.llm.common import keyed, mapped, only, sized, written
from mastline.llm.components import components

SEED = 42
BITS = 64
SEGMENT = 2  # bits of a segment
CELL_ROWS = 16_384  # fingerprints of a cell that one task compares; larger cells are cut into blocks
MEETINGS = 4096  # others that a random fingerprint may meet in all of its cells, about
_CHUNK = 1 << 16
_FLAT = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# Lower case for A-Z, and every other white space as a space.
_FLAT = bytes(32 if c in b"\x09\x0a\x0b\x0c\x0d" else c for c in _FLAT)


def fingerprint(text: str | None, shingle: int = 4) -> bytes:
    """SimHash of 64 bits over the text's word shingles, repeats included, big-endian.

    Lower-cases A-Z; words are runs of anything but ``[\\x20\\x09-\\x0D]``.  A text of fewer
    words is one shingle; a text without words gives zero, and so does null.
    A bit is set if over half the shingles' XXH64 (seed 42) have it.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").translate(_FLAT).split()
    if not parts:
        return bytes(8)
    flat = b" ".join(parts)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(size + 1) - 1
    n = max(1, len(parts) - shingle + 1)
    starts, ends = (end - size)[:n].tolist(), end[-n:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, _CHUNK):
        some = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=True)
        h = np.array([digest(flat[a:b], SEED) for a, b in some], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * counts > n, bitorder="little")[::-1].tobytes()


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp long) of every row of ``docs`` (doc_id, text); fp has the fingerprint's bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b"".join(fingerprint(t.as_py(), shingle) for t in b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.frombuffer(raw, ">i8").astype(np.int64))], ["doc_id", "fp"])

    return mapped(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def clean_groups(n: int, radius: int) -> int:
    """The smallest k for which one of ``n`` random fingerprints meets few others in cells of k groups among radius + k."""
    segments = BITS / SEGMENT
    alike = 3 / 8  # chance that two random segments of two bits have equal counts
    for k in range(1, 6):
        if n * comb(radius + k, k) * alike ** (segments * k / (radius + k)) <= MEETINGS:
            break
    return k


def cells(fp: np.ndarray, radius: int, clean: int) -> np.ndarray:
    """The cells (n, subsets) of fingerprints (n) uint64: one for each choice of ``clean`` among radius + clean groups of segments."""
    bits = (fp[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    counts = bits.reshape(len(fp), -1, SEGMENT).sum(2).astype(np.int64)
    cuts = np.linspace(0, counts.shape[1], radius + clean + 1).round().astype(int)
    codes = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        code = np.zeros(len(fp), np.int64)
        for s in range(a, b):
            code = code * (SEGMENT + 1) + counts[:, s]
        codes.append(code)
    top = (SEGMENT + 1) ** int(np.diff(cuts).max())
    out = []
    for number, chosen in enumerate(combinations(range(radius + clean), clean)):
        cell = np.full(len(fp), number, np.int64)
        for g in chosen:
            cell = cell * top + codes[g]
        out.append(cell)
    return np.stack(out, 1)


def forest(keys: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that connect what pairs within ``radius`` bits connect; keys (n) uint64.

    Each fingerprint is held once against those not reached yet: first the range of bit counts
    of the lower half, then the Manhattan distance of both halves' counts, then the bits.
    """
    half = np.uint64(BITS // 2)
    one = np.bitwise_count(keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    two = np.bitwise_count(keys >> half).astype(np.int64)
    rest = np.argsort(one, kind="stable")
    left, one, two = keys[rest], one[rest], two[rest]
    edges = []
    while len(rest) > 1:
        stack = [(left[0], one[0], two[0], rest[0])]
        left, one, two, rest = left[1:], one[1:], two[1:], rest[1:]
        while stack and len(rest):
            key, p, q, node = stack.pop()
            lo, hi = np.searchsorted(one, (p - radius, p + radius + 1))
            at = np.flatnonzero(abs(one[lo:hi] - p) + abs(two[lo:hi] - q) <= radius) + lo
            at = at[np.bitwise_count(left[at] ^ key) <= radius]
            if not len(at):
                continue
            edges += [(int(node), int(j)) for j in rest[at]]
            stack += [(left[j], one[j], two[j], rest[j]) for j in at]
            keep = np.ones(len(rest), bool)
            keep[at] = False
            left, one, two, rest = left[keep], one[keep], two[keep], rest[keep]
    return edges


def links(nodes: DataFrame, radius: int, clean: int | None = None) -> DataFrame:
    """(a, b): links that connect all fingerprints of the written ``nodes`` (fp long, distinct) within ``radius`` bits of each other.

    Every link is found.  A cell of more than CELL_ROWS is cut into blocks, and every pair of blocks is
    compared in a task of its own.  A task returns edges that connect, not all pairs.
    """
    clean = clean or clean_groups(nodes.count(), radius)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                fp = b.column(0).to_numpy(zero_copy_only=False)
                cell = cells(fp.view(np.uint64), radius, clean)
                yield pa.RecordBatch.from_arrays([pa.array(cell.ravel()), pa.array(np.repeat(fp, cell.shape[1]))], ["cell", "fp"])

    placed = mapped(nodes.select("fp"), place, "cell long, fp long")
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"))
    full = written(sizes.where(F.col("n") > CELL_ROWS), "cells")
    if full.isEmpty():
        blocks = placed.select("cell", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp")
    else:
        cut = placed.join(sized(full), "cell", "left").withColumn("k", F.ceil(F.coalesce("n", F.lit(1)) / CELL_ROWS).cast("int"))
        cut = cut.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
        cut = cut.withColumn("other", F.explode(F.expr("sequence(0, k - 1)")))
        blocks = cut.select("cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, 3):
            fp = np.concatenate([r.column(3).to_numpy(zero_copy_only=False) for r in rows])
            if len(fp) > 1 and (found := forest(fp.view(np.uint64), radius)):
                e = np.array(found)
                yield pa.RecordBatch.from_arrays([pa.array(fp[e[:, 0]]), pa.array(fp[e[:, 1]])], ["a", "b"])

    key = ["cell", "i", "j"]
    return mapped(blocks.repartition(*key).sortWithinPartitions(*key), compare, "a long, b long")


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Runs of equal values in the first ``keys`` columns (whole numbers) of sorted batches; each run as slices."""
    held: list[pa.RecordBatch] = []
    mark: tuple | None = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(b.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            now = tuple(int(c[s]) for c in cols)
            if now != mark:
                if held:
                    yield mark, held
                held, mark = [], now
            held.append(b.slice(s, e - s))
    if held:
        yield mark, held


def linked_prints(prints: DataFrame, radius: int, clean: int | None = None) -> DataFrame:
    """The written ``prints`` (doc_id, fp) with ``part``: a fingerprint that all linked ones share.

    Copies share a fingerprint and are one node.
    """
    nodes = written(prints.select("fp").distinct(), "nodes")
    found = written(components(links(nodes, radius, clean)), "parts")
    named = sized(found.select(F.col("node").alias("fp"), F.col("component").alias("part")))
    return prints.join(named, "fp", "left").select("doc_id", "fp", F.coalesce("part", "fp").alias("part"))


def clusters(prints: DataFrame, radius: int, clean: int | None = None) -> DataFrame:
    """(doc_id, fp, component_id) for a written table of fingerprints.

    component_id is the smallest doc_id that can be reached over links of at most ``radius``
    bits; rows without doc_id link nothing and keep a null component.
    """
    rows = written(linked_prints(prints.where("doc_id is not null"), radius, clean), "linked")
    name = rows.groupBy("part").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("size"))
    name = written(name.where("size > 1").drop("size"), "components")
    found = rows.join(sized(name), "part", "left").select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))
    lost = prints.where("doc_id is null").withColumn("component_id", F.col("doc_id"))
    return found.unionByName(lost)


def linked_documents(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fingerprint hex, component_id) of every row of ``docs``, with every link of at most ``radius`` bits.

    Null, empty and blank texts have the fingerprint zero, which links like any other; rows that
    repeat a doc_id or a text are linked with what any of them is linked with.  doc_id is of
    any type that has an order.  Texts are read whole, other columns not at all; an empty table
    gives no rows.
    """
    prints = written(fingerprints(docs, shingle), "prints")
    found = clusters(prints, radius)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each group of linked fingerprints: the one with the smallest doc_id, null last.

    Of several rows with that doc_id the one with the smallest digest of its text stays, then
    the first by the other columns.  Texts without words are one group.  Columns, whatever
    their names, are those of ``docs``; an empty table stays empty.
    """
    rows = linked_prints(written(fingerprints(keyed(docs), shingle), "prints"), radius).select("doc_id.*", "part")
    rows = written(rows, "linked")
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "mark")
    best = written(rows.groupBy("part").agg(F.min(row).alias("best"), F.count("*").alias("size")).where("size > 1"), "best")
    decided = rows.join(sized(best), "part").select("doc_id", "mark", row.eqNullSafe(F.col("best")).alias("stays"))
    return only(docs, written(decided, "near"))
