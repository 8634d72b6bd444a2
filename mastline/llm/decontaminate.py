"""Benchmark decontamination by q-gram counts in diagonal bands and banded alignment.

By the q-gram lemma a stretch of text within e edits of a passage of m characters shares at
least m + 1 - q - q * e q-grams with it, all on diagonals (text position minus passage
position) that differ by at most e.  Shared q-grams are counted per passage in
overlapping bands of diagonals; bands that reach the bound are aligned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastline.llm.common import Rolling, Words, byte_table, keyed, mapped, sliced, utf8, without, written

Q = 8
EDIT_RATE = 0.08  # edits allowed per character of a passage
PASSAGE, STEP = 400, 200  # bytes of a passage of a longer item, and from one to the next
FREQUENT = 64  # passages that may share a q-gram before they give it up where they can
LEAST = 24  # bytes of an item for whose sake a document is dropped
BLOCK_BYTES = 16 << 20  # passages searched for at once; a larger benchmark takes several passes over the texts
_MAP_BITS = 20
# Fixed value: the ASCII characters that count; all others part words.
_KEEP = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_TABLE = byte_table(_KEEP, lower=True)


def normalised(text: str | None) -> bytes:
    """Lower-case letters, digits and non-ASCII characters, words parted by one space; UTF-8."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return Words(raw, np.array([0, len(raw)]), _TABLE).text[:-1].tobytes()


def edit_budget(m: int, q: int = Q, rate: float = EDIT_RATE) -> int:
    """Edits allowed for ``m`` bytes: by rate, as far as the lemma leaves at least one shared q-gram."""
    return max(0, min(int(m * rate), (m - q) // q))


def cut(text: bytes, size: int = PASSAGE, step: int = STEP) -> list[bytes]:
    """The passages of a normalised item: itself, or overlapping stretches of ``size`` bytes that cover it."""
    if len(text) <= size + step:
        return [text]
    starts = [*range(0, len(text) - size, step), len(text) - size]
    return [text[a : a + size] for a in starts]


class Passages:
    """A block of normalised passages with their q-grams in a sorted hash array."""

    def __init__(self, items: list[bytes], q: int = Q, rate: float = EDIT_RATE):
        self.q = q
        self.texts, owner = [], []
        for k, item in enumerate(items):
            for part in cut(item):
                self.texts.append(part)
                owner.append(k)
        self.owner = np.array(owner, np.int64)
        self.size = np.array([len(t) for t in self.texts], np.int64)
        self.budget = np.array([edit_budget(len(t), q, rate) for t in self.texts], np.int64)
        grams = np.maximum(0, self.size + 1 - q)
        self.need = np.maximum(1, grams - q * self.budget)
        self.short = [i for i, t in enumerate(self.texts) if 0 < len(t) < q]
        hashes, item, at = [np.zeros(0, np.uint64)], [], []
        for i, t in enumerate(self.texts):
            if grams[i] > 0:
                s = np.arange(grams[i])
                hashes.append(Rolling(np.frombuffer(t, np.uint8))(s, s + q))
                item.append(np.full(grams[i], i))
                at.append(s)
        h = np.concatenate(hashes)
        item, at = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (item, at))
        keep = self._kept(h, item, grams)
        h, item, at = h[keep], item[keep], at[keep]
        order = np.argsort(h, kind="stable")
        self.gram, first = np.unique(h[order], return_index=True)
        self.first = np.append(first, len(h))
        self.item, self.at = item[order], at[order]
        self.map = np.zeros(1 << _MAP_BITS, bool)
        self.map[self.gram >> np.uint64(64 - _MAP_BITS)] = True

    def _kept(self, h: np.ndarray, item: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """Which q-grams are kept: those that few passages share, and the rarest others as far as a passage needs them.

        Of n q-grams a match shares ``need`` or more.  If n - r are given up it shares need - (n - r) of the
        others or more, which is one at least as long as r > n - need.
        """
        _, back, often = np.unique(h, return_inverse=True, return_counts=True)
        often = often[back] if len(h) else np.zeros(0, np.int64)
        order = np.lexsort((often, item))
        start = np.cumsum(grams) - grams
        rank = np.empty(len(h), np.int64)
        rank[order] = np.arange(len(h)) - start[item[order]]
        keep = (often <= FREQUENT) | (rank <= (grams - self.need)[item])
        given_up = np.bincount(item[~keep], minlength=len(grams))
        self.need = np.maximum(1, self.need - given_up)
        return keep

    def search(self, data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start, end, edits) of the best match of each item, or a passage of it, in each text of a slice."""
        words = Words(data, bounds, _TABLE)
        text, q, found = words.text, self.q, []
        begin = words.start[words.first]  # of each text in the joined words
        n = len(text) - q + 1
        if n > 0 and len(self.gram):
            s = np.arange(n)
            h = Rolling(text)(s, s + q)
            s = np.flatnonzero(self.map[h >> np.uint64(64 - _MAP_BITS)])
            g = np.minimum(np.searchsorted(self.gram, h[s]), len(self.gram) - 1)
            s, g = (x[self.gram[g] == h[s]] for x in (s, g))
            doc = np.searchsorted(begin, s, "right") - 1
            inside = s + q <= begin[doc + 1]
            found = self._regions(s[inside], g[inside], doc[inside], text, begin)
        for d in range(len(bounds) - 1) if self.short else ():
            t = text[begin[d] : max(begin[d], begin[d + 1] - 1)].tobytes()
            found += [(d, i, p, p + len(self.texts[i]), 0) for i in self.short if (p := (b" " + t + b" ").find(b" " + self.texts[i] + b" ")) >= 0]
        best: dict = {}
        for d, i, a, b, e in found:
            k = int(self.owner[i])
            best[d, k] = min(best.get((d, k), (e, a, b)), (e, a, b))
        return [(d, k, a, b, e) for (d, k), (e, a, b) in sorted(best.items())]

    def _regions(self, s, g, doc, text, begin):
        """Bands of diagonals with enough shared q-grams, aligned."""
        many = self.first[g + 1] - self.first[g]
        row = np.repeat(np.arange(len(s)), many)
        post = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + self.first[g][row]
        item, doc, diagonal = self.item[post], doc[row], s[row] - self.at[post]
        width = self.budget[item] + 1
        band = (diagonal + (1 << 40)) // width
        # A band spans two widths, so any e + 1 neighbouring diagonals lie in one.
        key = np.stack([np.concatenate([doc, doc]), np.concatenate([item, item]), np.concatenate([band, band - 1])])
        if not key.shape[1]:
            return []
        order = np.lexsort(key[::-1])
        key = key[:, order]
        new = np.append(True, (key[:, 1:] != key[:, :-1]).any(0))
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, key.shape[1]))
        out, last = [], None
        for d, i, b in key[:, head[count >= self.need[key[1, head]]]].T.tolist():
            e = int(self.budget[i])
            low = b * (e + 1) - (1 << 40)
            if last and last[:2] == (d, i) and low <= last[3]:  # neighbours overlap
                last = (d, i, last[2], low + 2 * e + 1)
                out[-1] = last
            else:
                last = (d, i, low, low + 2 * e + 1)
                out.append(last)
        found = []
        for d, i, low, high in out:
            e, m = int(self.budget[i]), int(self.size[i])
            base, end = int(begin[d]), int(begin[d + 1]) - 1
            a, b = max(base, low - e), min(end, high + m + e)
            # An alignment that keeps to its budget strays e diagonals from the q-grams it shares.
            hit = align(self.texts[i], text[a:b].tobytes(), e, low - e - a, high + e - a)
            if hit:
                found.append((d, i, a - base + hit[0], a - base + hit[1], hit[2]))
        return found


def align(passage: bytes, region: bytes, budget: int, low: int | None = None, high: int | None = None) -> tuple[int, int, int] | None:
    """(start, end, edits) of the stretch of ``region`` nearest to the passage, if within the budget.

    Edit distance with free ends in the region, over the cells whose diagonal (place in the region less
    place in the passage) is ``low`` to ``high``; without them over all.
    """
    at = region.find(passage)
    if at >= 0:
        return at, at + len(passage), 0
    p, t = np.frombuffer(passage, np.uint8), np.frombuffer(region, np.uint8)
    n, m = len(t), len(p)
    low, high = (-m if low is None else low), (n if high is None else high)
    if high < low:
        return None
    # Each cell carries its start: cost * 2^32 + start, so that ties take the earliest.
    one = 1 << 32
    far = np.int64(1) << 60
    diagonal = np.arange(low, high + 1)
    gain = np.arange(len(diagonal)) * one
    # Outside of the region is a byte that no passage has.
    padded = np.concatenate([np.full(max(0, -low), -1, np.int16), t.astype(np.int16), np.full(max(0, high + m - n) + 1, -1, np.int16)])
    shift = max(0, -low)
    row = np.where((diagonal >= 0) & (diagonal <= n), diagonal, far)
    for i, c in enumerate(p):
        j = diagonal + i  # place in the region of the byte that is compared
        here = padded[low + i + shift : high + 1 + i + shift]
        new = np.where((j >= 0) & (j < n), row + (here != c) * one, far)
        new[:-1] = np.minimum(new[:-1], row[1:] + one)
        new[-1] = min(new[-1], far)
        new = np.where((j + 1 >= 0) & (j + 1 <= n), new, far)
        row = np.minimum.accumulate(new - gain) + gain
        row = np.where((j + 1 >= 0) & (j + 1 <= n), row, far)
        if (row.min() >> 32) > budget:
            return None
    best = int(np.argmin(row >> 32))
    cost, start = int(row[best] >> 32), int(row[best] & (one - 1))
    return (start, int(diagonal[best]) + m, cost) if cost <= budget else None


def leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE) -> DataFrame:
    """(doc_id, item_id, start, end, edits): items of ``benchmark`` (item_id, text) found in ``docs`` (doc_id, text).

    One row per document and item, with the best match of the item or, if it is longer than PASSAGE + STEP, of
    a passage of it; offsets are bytes of the normalised text.  Items are searched for in
    blocks of bounded size, each against all texts.  Items shorter than q must occur as whole words,
    exactly.  Null or empty items match nothing, null or empty texts hold nothing; equal items each
    match, rows that repeat a doc_id or a text each have theirs.  Texts are read whole, other
    columns, whatever their names, not at all; empty tables give no rows.
    """
    found = _found(docs, benchmark, q, rate)
    named = benchmark.select("item_id", F.xxhash64("text").alias("__item")).where(F.col("text").isNotNull())
    return found.join(named, "__item").select("doc_id", "item_id", "start", "end", "edits")


def _found(docs: DataFrame, benchmark: DataFrame, q: int, rate: float, least: int = 0) -> DataFrame:
    """``leaks`` by the digest ``__item`` of an item's text; items of fewer than ``least`` normalised bytes are left out."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = benchmark.select("text").where("text is not null").distinct()
    n = int((texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES) + 1
    texts = texts.withColumn("item", F.xxhash64("text")).withColumn("block", F.pmod(F.xxhash64("text", F.lit(1)), F.lit(n)))
    parts = []
    for k in range(n):
        rows = texts.where(F.col("block") == k).select("item", "text").orderBy("item").collect()  # BLOCK_BYTES or so
        held = [(r[0], t) for r in rows if len(t := normalised(r[1])) >= max(1, least)]
        block = spark.sparkContext.broadcast(held)

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            passages = Passages([t for _, t in block.value], q, rate)
            ids = pa.array([x for x, _ in block.value], pa.int64())
            for b in batches:
                for first, _, data, bounds in sliced(*utf8(b.column(1))):
                    if found := passages.search(data, bounds):
                        d, i, s, e, cost = (pa.array(x, pa.int64()) for x in zip(*found, strict=True))
                        yield pa.RecordBatch.from_arrays([b.column(0).slice(first).take(d), ids.take(i), s, e, cost], ["doc_id", "__item", "start", "end", "edits"])

        parts.append(mapped(docs.select("doc_id", "text"), run, f"doc_id {kind}, __item long, start long, end long, edits long"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE, least: int = LEAST) -> DataFrame:
    """``docs`` less the rows whose text holds an item of the benchmark, or a passage of a long one; columns as they are.

    Items of fewer than ``least`` normalised bytes (a bare "yes") drop nothing.  Each row is judged by its own
    text: others with its doc_id, or without one, stay.  Null and empty texts stay, and so do rows
    that repeat, all or none of them; an empty table stays empty.
    """
    gone = written(_found(keyed(docs), benchmark, q, rate, least).select("doc_id.*").distinct(), "leaks")
    return without(docs, gone)
