"""Removal of repeated passages with suffix groups.

Every window of ``window`` words is the path from the root of a suffix tree down to that
depth; a deep node with two or more suffixes below it is a repeat.  Suffixes are parted by a
prefix that a window itself decides, its anchor: the word 5-gram with the smallest hash
inside.  Equal windows have equal anchors, so each group holds whole nodes.
Groups that would not fit one task's memory are split: frequent anchors are spread over as many
salts as they need, and any group is worked on in pieces.  The first windows of the pieces
are then compared by the whole window as their prefix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mastline.llm.common import Rolling, Words, byte_table, mapped, mixed, signed, sliced, utf8, written

WINDOW = 20
GRAM = 5
COUNTERS = 8192  # per task, to find anchors with very many suffixes
LONG_GROUP = 50_000  # rows of an anchor beyond which it is salted, and rows of a group that are held at once
LONG_GROUPS = 65_536  # anchors that are broadcast as such; others with very many rows are only worked on in pieces
_SALT_BITS = 20  # of a salted anchor, in place of its lowest ones
_TABLE = byte_table()
_HASH_BYTES = 6  # of a window, beside the 8 of its anchor


def anchored(data: np.ndarray, bounds: np.ndarray, window: int, gram: int):
    """Runs of windows with one anchor: (anchor, text, first word, windows), and the windows' hashes in order."""
    words = Words(data, bounds, _TABLE)
    n = words.n - window + 1
    if n <= 0:
        return None
    s, text = words.start, words.text
    i = np.arange(n)
    inside = words.doc[i] == words.doc[i + window - 1]
    g = np.arange(words.n - gram + 1)
    low = Rolling(text, 1)(s[g], s[g + gram] - 1)
    span, width = 1, window - gram + 1
    while span < width:
        step = min(span, width - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    low = low[:n]
    whole = Rolling(text, 0)(s[i], s[i + window] - 1)
    at = i[inside]
    if not len(at):
        return None
    low, whole, doc = low[at], whole[at], words.doc[at]
    new = np.ones(len(at), bool)
    new[1:] = (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    return low[head], doc[head], (at - words.first[doc])[head], np.diff(np.append(head, len(at))), whole


def unsalted(anchor: np.ndarray) -> np.ndarray:
    """The bits of anchors that a salt leaves as they are."""
    return anchor >> np.uint64(_SALT_BITS) << np.uint64(_SALT_BITS)


def crowded(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(a, n): anchors with more than LONG_GROUP rows, from Misra-Gries counters of each task over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        pending: list[np.ndarray] = []

        def merge(key, count):
            every = np.concatenate([key, *pending])
            weight = np.concatenate([count, np.ones(len(every) - len(key), np.int64)])
            key, back = np.unique(every, return_inverse=True)
            count = np.bincount(back, weight, len(key)).astype(np.int64)
            if len(key) > COUNTERS:
                count -= np.partition(count, -COUNTERS - 1)[-COUNTERS - 1]
                key, count = key[count > 0], count[count > 0]
            pending.clear()
            return key, count

        for b in batches:
            for _, _, data, bounds in sliced(*utf8(b.column(0))):
                if (found := anchored(data, bounds, window, gram)) is not None:
                    pending.append(found[0])
                    if sum(map(len, pending)) > 500_000:
                        key, count = merge(key, count)
        key, count = merge(key, count)
        keep = count > 1
        yield pa.RecordBatch.from_arrays([pa.array(signed(key[keep])), pa.array(count[keep])], ["a", "n"])

    found = mapped(docs.where("doc_id is not null").select("text"), run, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") > LONG_GROUP).orderBy(F.desc("n"), "a").limit(LONG_GROUPS)


def suffixes(docs: DataFrame, long: np.ndarray, salts: np.ndarray, window: int, gram: int) -> DataFrame:
    """(a, doc, mark, start, wins): runs of windows by anchor; those of long groups are salted and have start < 0.

    ``long`` holds the anchors of long groups in order, ``salts`` how many parts each gets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, marks = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            for first, _, data, bounds in sliced(*utf8(b.column(1))):
                if (found := anchored(data, bounds, window, gram)) is None:
                    continue
                low, doc, start, many, whole = found
                doc, mark = ids[doc + first], marks[doc + first]
                if len(long):
                    at = np.minimum(np.searchsorted(long, low), len(long) - 1)
                    hot = long[at] == low
                    salt = mixed(doc.astype(np.uint64)) % salts[at]
                    low = np.where(hot, unsalted(low) | salt, low)
                    start = np.where(hot, -start - 1, start)
                packed = np.ascontiguousarray(whole.view(np.uint8).reshape(-1, 8)[:, 8 - _HASH_BYTES :])
                offsets = np.append(0, np.cumsum(many) * _HASH_BYTES).astype(np.int32)
                wins = pa.Array.from_buffers(pa.binary(), len(many), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays([pa.array(signed(low)), pa.array(doc), pa.array(mark), pa.array(start.astype(np.int32)), wins], ["a", "doc", "mark", "start", "wins"])

    return mapped(docs.where("doc_id is not null").select("doc_id", "text", _mark().alias("mark")), run, "a long, doc long, mark long, start int, wins binary")


def _mark() -> Column:
    """Names a row together with its doc_id."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def repeats(rows: DataFrame, window: int) -> DataFrame:
    """(node, doc, mark, start, end): stretches of words that earlier windows of their group cover.

    For salted groups, and for those worked on in pieces, also the first windows of each
    part, with their node and end -1: the parts' firsts are compared once more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last group so far
        key, size, pieces = None, 0, False
        for b in batches:
            if not b.num_rows:
                continue
            a = b.column(0).to_numpy()
            if held and a[0] != key:
                yield _marks(held, window, pieces)
                held, size, pieces = [], 0, False
            ends = np.append(np.flatnonzero(a[1:] != a[:-1]) + 1, len(a))
            if pieces and len(ends) > 1:  # the rest of a group in pieces apart from whole groups
                yield _marks([*held, b.slice(0, ends[0])], window, True)
                held, size, pieces = [], 0, False
                b, a = b.slice(ends[0]), a[ends[0] :]
                ends = ends[1:] - ends[0]
            if len(ends) > 1:
                yield _marks([*held, b.slice(0, ends[-2])], window, False)
                held, size, pieces = [], 0, False
                b = b.slice(ends[-2])
            held.append(b)
            key, size = a[-1], size + b.num_rows
            if size > LONG_GROUP:
                yield _marks(held, window, True)
                held, size, pieces = [], 0, True
        if held:
            yield _marks(held, window, pieces)

    parts = rows.repartition("a").sortWithinPartitions("a", "doc", "mark", F.abs("start"))
    return mapped(parts, run, "node long, doc long, mark long, start int, end int")


def _marks(batches: list[pa.RecordBatch], window: int, piece: bool) -> pa.RecordBatch:
    """Repeats within whole groups or a piece of one, rows in order of (group, document, start)."""
    t = pa.Table.from_batches(batches).combine_chunks()
    a, doc, mark, start = (t.column(i).to_numpy() for i in range(4))
    wins = t.column(4).combine_chunks()
    if isinstance(wins, pa.ChunkedArray):
        wins = wins.chunk(0)
    offsets = np.frombuffer(wins.buffers()[1], np.int32, len(wins) + 1, wins.offset * 4)
    raw = np.frombuffer(wins.buffers()[2], np.uint8, offsets[-1] - offsets[0], offsets[0]).reshape(-1, _HASH_BYTES)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, 8 - _HASH_BYTES :] = raw
    many = np.diff(offsets) // _HASH_BYTES
    row = np.repeat(np.arange(len(many)), many)
    hot = start < 0
    first = np.where(hot, -start - 1, start)
    step = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    at = first[row] + step
    node = mixed(full.view(np.uint64).ravel() ^ mixed(a.view(np.uint64))[row])
    order = np.argsort(node, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = node[order][1:] != node[order][:-1]
    lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    repeat = np.zeros(len(order), bool)
    # A row given twice under one doc_id is not earlier than itself.
    same = (doc[row[order]] == doc[row[lead]]) & (mark[row[order]] == mark[row[lead]])
    repeat[order] = ~same | (at[order] != at[lead])
    # Neighbouring repeats of a row as one stretch.
    begin = repeat.copy()
    begin[1:] &= ~(repeat[:-1] & (row[1:] == row[:-1]))
    end = repeat.copy()
    end[:-1] &= ~(repeat[1:] & (row[1:] == row[:-1]))
    s, e = np.flatnonzero(begin), np.flatnonzero(end)
    again = np.flatnonzero(~repeat & (hot[row] | piece))  # the salt is not part of a window's name
    anchor = mixed(unsalted(a.view(np.uint64)))[row[again]]
    name = np.concatenate([np.zeros(len(s), np.int64), signed(mixed(full.view(np.uint64).ravel()[again] ^ anchor))])
    docs, marks = (np.concatenate([x[row[s]], x[row[again]]]) for x in (doc, mark))
    starts = np.concatenate([at[s], at[again]])
    ends = np.concatenate([at[e] + window, np.full(len(again), -1)])
    return pa.RecordBatch.from_arrays([pa.array(name), pa.array(docs), pa.array(marks), pa.array(starts.astype(np.int32)), pa.array(ends.astype(np.int32))], ["node", "doc", "mark", "start", "end"])


def repeated_stretches(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc, mark, start, end): word stretches of documents that windows with an earlier copy cover; they may overlap.

    Windows are compared by hashes of their words: 64 bits of the anchor (44 if its group is
    split) and 48 of the window.
    """
    found = crowded(docs, window, gram).toArrow()  # LONG_GROUPS rows at most
    order = np.argsort(found.column("a").to_numpy().view(np.uint64))
    long = found.column("a").to_numpy().view(np.uint64)[order]
    salts = np.clip(found.column("n").to_numpy()[order] * 4 // LONG_GROUP, 1, 1 << _SALT_BITS).astype(np.uint64)
    marks = written(repeats(suffixes(docs, long, salts, window, gram), window), "marks")
    firsts = marks.where("end < 0")
    # A window of a split group has one first per part; parts of them are compared map-side.
    lead = firsts.groupBy("node").agg(F.min(F.struct("doc", "mark", "start")).alias("lead"))
    later = firsts.join(lead, "node").where("lead.doc != doc or lead.mark != mark or lead.start != start")
    later = later.select("doc", "mark", "start", (F.col("start") + window).alias("end"))
    return marks.where("end >= 0").select("doc", "mark", "start", "end").union(later)


def dedup_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row of ``docs`` (doc_id long, text).

    A word goes if a window of ``window`` words over it also starts earlier: in a document
    with a smaller doc_id, or before in the same one.  ``kept`` is what is left, parted by one
    space.  Null has no words.  Rows without doc_id stay whole and are nobody's earlier copy.
    Rows that repeat both doc_id and text are one document; of rows with one doc_id and several
    texts, those of one text (in an order fixed by a hash) are the earlier document.  Texts of any length
    are read whole, other columns not at all; an empty table gives no rows.
    """
    spans = repeated_stretches(docs, window, gram).groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    both = docs.select("doc_id", "text", _mark().alias("__mark"))
    both = both.join(spans.hint("shuffle_hash"), (F.col("doc_id") == F.col("doc")) & (F.col("__mark") == F.col("mark")), "left")
    both = both.select("doc_id", "text", F.expr("transform(spans, x -> x.start)").alias("s"), F.expr("transform(spans, x -> x.end)").alias("e"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, kept = [], [], []
            for text, s, e in zip(*(b.column(k) for k in (1, 2, 3)), strict=True):
                words = (text.as_py() or "").encode().split()
                n.append(len(words))
                if s.is_valid and len(s):
                    change = np.zeros(len(words) + 1, np.int32)
                    np.add.at(change, s.values.to_numpy(), 1)
                    np.add.at(change, e.values.to_numpy(), -1)
                    stay = np.cumsum(change[:-1]) == 0
                    gone.append(int(len(words) - stay.sum()))
                    words = [w for w, k in zip(words, stay.tolist(), strict=True) if k]
                else:
                    gone.append(0)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])

    return mapped(both, run, "doc_id long, n_words long, n_removed long, kept binary")


def passages_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row, as ``dedup_passages`` says."""
    return dedup_passages(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
