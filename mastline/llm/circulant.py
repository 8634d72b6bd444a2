"""Near-duplicates by circulant MinHash: two permutations make every coordinate, bands find candidates, sets decide.

A first permutation of the 64-bit shingle hashes breaks up their order; a second one, shifted
circularly by a fixed step per coordinate, gives coordinate k as the minimum over a
document's shingles.  With 26 bands of five coordinates, a pair at similarity 0.85 shares no
band once in four million times.  Pairs that share one are compared by a byte of each
coordinate (a pair at 0.85 falls below the limit once in ten million times) and then
by their whole shingle sets, which alone decide.

Equal sets are one node.  Every node of a bucket is first held against the bucket's
leader; whoever is linked needs no further comparison with its own component, so a large group
of near-copies takes about one pair per member.  What is left in other components visits
all of its bucket, in blocks of bounded size: first by signatures, then, in the first bucket
of each likely pair only, by whole sets.  A block returns links that connect, not all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastline.llm.common import Rolling, Words, byte_table, mapped, mixed, signed, sized, sliced, utf8, written
from mastline.llm.components import components

SHINGLE = 3
PERCENT = 85  # of the union that the intersection has to reach
BANDS, ROWS = 26, 5
LIKELY = 0.66  # share of equal signature bytes below which no pair of the wanted similarity falls
BLOCK_SHINGLES = 1 << 21  # of a bucket that are held at once
PAIRS_OF_SET = 512  # comparisons for which a set is sent once
_STEP = 0x9E3779B97F4A7C15  # of the circular shift
_OTHER = np.uint64(0xA0761D6478BD642F)
_TABLE = byte_table(lower=True)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text of a slice, in order, and where each text's begin.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    words = Words(data, bounds, _TABLE)
    many = np.where(words.per_doc > 0, np.maximum(1, words.per_doc - shingle + 1), 0)
    doc = np.repeat(np.arange(len(many)), many)
    first = words.first[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    last = np.minimum(first + shingle, words.first[1:][doc]) - 1
    h = np.zeros(0, np.uint64)
    if len(doc):
        h = Rolling(words.text)(words.start[first], words.start[last] + words.length[last])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(many) + 1))


def signatures(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """``size`` circulant MinHash coordinates of each set (none may be empty)."""
    out = np.empty((len(at) - 1, size), np.uint64)
    if not len(out):
        return out
    start = mixed(h ^ _OTHER)  # the first permutation
    for k in range(size):
        turned = start + np.uint64(_STEP * k & (1 << 64) - 1)
        out[:, k] = np.minimum.reduceat(mixed(turned), at[:-1])  # the second one, shifted
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per document and band."""
    keys = np.empty((len(signature), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(signature), mixed(np.array([b + 1], np.uint64))[0])
        for k in range(b * rows, (b + 1) * rows):
            key = mixed(key ^ signature[:, k])
        keys[:, b] = key
    return keys


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(signed(values.ravel())))


def _bytes(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    offsets = pa.py_buffer(np.arange(n + 1, dtype=np.int32) * width)
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


def signed_documents(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n, digest, bands, sketch) of every row: set size, and of a set that is not empty its name, band keys and signature bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, data, bounds in sliced(*utf8(b.column(1))):
                h, at = shingle_sets(data, bounds, shingle)
                n = np.diff(at)
                full = np.flatnonzero(n)
                place = pa.array(np.where(n > 0, np.cumsum(n > 0) - 1, 0), pa.int64(), mask=n == 0)
                sig = signatures(h, np.append(at[:-1][full], len(h)), bands * rows)
                ends = at.tolist()
                name = [hashlib.blake2b(h[ends[i] : ends[i + 1]].tobytes(), digest_size=16).digest() for i in full.tolist()]
                cols = [pa.array(name, pa.binary()), _lists(band_keys(sig, bands, rows)), _bytes(sig.astype(np.uint8))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, last - first), pa.array(n), *(c.take(place) for c in cols)],
                    ["doc_id", "n", "digest", "bands", "sketch"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), run, f"doc_id {kind}, n long, digest binary, bands array<long>, sketch binary")


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node): nodes by the band keys that several nodes have."""
    placed = nodes.select(F.explode("bands").alias("bucket"), "node")
    held = placed.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1")
    return placed.join(sized(written(held.select("bucket"), "buckets")), "bucket")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(x, np.uint8) for x in column.to_pylist()])


def _may(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be as similar."""
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def leader_pairs(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): every node of a bucket with the bucket's first node, where sizes and signatures allow a link.

    Leaders are found by a map-side combined minimum and joined back, so no bucket has to meet in
    one task.  Sizes and signatures are brought to pairs that several buckets may have named just once.
    """
    lead = rows.groupBy("bucket").agg(F.min("node").alias("a"))
    pairs = rows.join(lead, "bucket").where("node != a").select("a", F.col("node").alias("b")).distinct()
    small = nodes.select("node", "n", "sketch")
    both = pairs.join(small.toDF("a", "na", "sa"), "a").join(small.toDF("b", "nb", "sb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for at in range(0, t.num_rows, 4096):
                b = t.slice(at, 4096)
                na, nb = b.column(2).to_numpy(), b.column(3).to_numpy()
                good = _may(na, nb, percent) & ((_matrix(b.column(4)) == _matrix(b.column(5))).mean(1) >= LIKELY)
                yield b.select(["a", "b"]).filter(pa.array(good))

    return mapped(both.select("a", "b", "na", "nb", "sa", "sb"), run, "a long, b long").distinct()


def visits(rows: DataFrame, nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """What is still to be compared: (bucket, block, guest, node, part, small, n, bands, sketch).

    ``parts`` (node, part) has the linked nodes.  Only buckets with several parts are left.  Each
    node lies in a block of its bucket, which holds BLOCK_SHINGLES or so; nodes outside the
    bucket's largest part (``small``) are also guests in every block.
    """
    named = rows.join(sized(parts), "node", "left").withColumn("part", F.coalesce("part", "node"))
    sizes = named.groupBy("bucket", "part").agg(F.count("*").alias("k"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("k", "part")).alias("main"), F.count("*").alias("parts"))
    main = written(main.where("parts > 1").select("bucket", F.col("main.part").alias("main")), "open")
    left = named.join(sized(main), "bucket").join(nodes.select("node", "n", "bands", "sketch"), "node")
    left = left.where(F.array_contains("bands", F.col("bucket")))  # a doc_id given to several texts names several sets
    left = written(left.withColumn("small", F.col("part") != F.col("main")).drop("main"), "left")
    weight = left.groupBy("bucket").agg(F.ceil(F.sum(F.col("n") + 256) / BLOCK_SHINGLES).cast("int").alias("blocks"))
    large = sized(written(weight.where("blocks > 1"), "large"))
    left = left.join(large, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    out = ["bucket", "block", "guest", "node", "part", "small", "n", "bands", "sketch"]
    own = left.withColumns({"block": F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), "guest": F.lit(False)})
    guests = left.where("small").withColumns({"block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "guest": F.lit(True)})
    return own.select(*out).unionByName(guests.select(*out))


def _by_block(batches: Iterator[pa.RecordBatch], make, visit, leave) -> Iterator[pa.RecordBatch]:
    """Residents of each block through ``make``, its guests as they come through ``visit(home, guests)``, then ``leave(home)``.

    Rows are sorted by bucket, block and guest.
    """
    key, held, home = None, [], None
    for b in batches:
        if not b.num_rows:
            continue
        bucket, block = (b.column(i).to_numpy() for i in (0, 1))
        change = (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            if (bucket[s], block[s]) != key:
                if home is not None:
                    yield from leave(home)
                key, held, home = (bucket[s], block[s]), [], None
            part = b.slice(s, e - s)
            m = int((~part.column(2).to_numpy(zero_copy_only=False)).sum())
            if m:
                held.append(part.slice(0, m))
            if m < e - s and held:
                home = home or make(held)
                yield from visit(home, part.slice(m))
    if home is not None:
        yield from leave(home)


class _Nodes:
    """Rows of ``visits`` as arrays."""

    def __init__(self, rows: list[pa.RecordBatch]):
        table = pa.Table.from_batches(rows)
        self.rows = table.select(["bucket", "block", "guest", "node", "part", "small"])
        self.node, self.part, self.n = (table.column(c).to_numpy() for c in ("node", "part", "n"))
        self.small = table.column("small").to_numpy()
        self.bands = np.array(table.column("bands").to_pylist(), np.int64)
        self.sketch = _matrix(table.column("sketch"))
        self.band = np.flatnonzero(self.bands[0] == table.column("bucket")[0].as_py())[0]
        self.near = np.zeros(len(self.node), bool)


def _strangers(home, guests, rows: np.ndarray, cols: slice, percent: int) -> np.ndarray:
    """Which residents each guest is to be held against: of another part and a size that fits.

    Two small nodes are each other's guests: one of the two comparisons is enough.
    """
    fit = ~home.small[None, cols] | (home.node[None, cols] < guests.node[rows, None])
    return fit & (home.part[None, cols] != guests.part[rows, None]) & _may(home.n[None, cols], guests.n[rows, None], percent)


def likely_rows(rows: DataFrame, percent: int) -> DataFrame:
    """(bucket, block, guest, node, part, small): rows of ``visits`` with a likely link of which theirs is the first bucket."""

    def visit(home: _Nodes, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        guests = _Nodes([batch])
        for at in range(0, len(guests.node), 64):
            some = np.arange(at, min(at + 64, len(guests.node)))
            for first in range(0, len(home.node), 256):
                cols = slice(first, first + 256)
                i, j = np.nonzero(_strangers(home, guests, some, cols, percent))
                i, j = some[i], j + first
                near = (home.sketch[j] == guests.sketch[i]).mean(1) >= LIKELY if len(i) else np.zeros(0, bool)
                i, j = i[near], j[near]
                # The pair counts in the first of the buckets it shares.
                mine = (home.bands[j] == guests.bands[i]).argmax(1) == home.band if len(i) else np.zeros(0, bool)
                guests.near[i[mine]] = home.near[j[mine]] = True
        yield from guests.rows.filter(pa.array(guests.near)).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _by_block(batches, _Nodes, visit, lambda home: home.rows.filter(pa.array(home.near)).to_batches())

    ordered = rows.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "guest")
    return mapped(ordered, run, "bucket long, block int, guest boolean, node long, part long, small boolean")


class _Sets:
    """Rows of ``likely_rows`` with their sets, as one sorted array of shingles with the row of each."""

    def __init__(self, rows: list[pa.RecordBatch]):
        table = pa.Table.from_batches(rows)
        self.node, self.part = (table.column(c).to_numpy() for c in ("node", "part"))
        self.small = table.column("small").to_numpy()
        self.sets = [np.frombuffer(x, np.uint64) for x in table.column("h").to_pylist()]
        self.n = np.array([len(x) for x in self.sets], np.int64)
        self.group = {p: p for p in self.part.tolist()}

    def sort(self) -> None:
        owner = np.repeat(np.arange(len(self.n)), self.n)
        every = np.concatenate(self.sets)
        order = np.argsort(every, kind="stable")
        self.shingle, self.owner = every[order], owner[order]

    def shared(self, h: np.ndarray) -> np.ndarray:
        """How many shingles each row has in common with a set."""
        low, high = np.searchsorted(self.shingle, h, "left"), np.searchsorted(self.shingle, h, "right")
        many = high - low
        at = np.arange(many.sum()) + np.repeat(low - np.cumsum(many) + many, many)
        return np.bincount(self.owner[at], minlength=len(self.n))

    def root(self, part: int) -> int:
        group = self.group
        while (up := group.setdefault(part, part)) != part:
            group[part] = group[up]
            part = group[part]
        return part


def visited(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between the parts of ``likely_rows``, by whole sets; those that connect, not all pairs."""

    def make(held: list[pa.RecordBatch]) -> _Sets:
        home = _Sets(held)
        home.sort()
        return home

    def visit(home: _Sets, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        guests, pairs = _Sets([batch]), []
        for g in range(len(guests.node)):
            fit = _strangers(home, guests, np.array([g]), slice(None), percent)[0]
            if not fit.any():
                continue
            both = home.shared(guests.sets[g])
            for j in np.flatnonzero(fit & (100 * both >= percent * (home.n + guests.n[g] - both))).tolist():
                one, two = home.root(int(home.part[j])), home.root(int(guests.part[g]))
                if one != two:
                    home.group[max(one, two)] = min(one, two)
                    pairs.append((int(home.node[j]), int(guests.node[g])))
        if pairs:
            a, b = zip(*pairs, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _by_block(batches, make, visit, lambda home: ())

    full = rows.join(sets, "node").select("bucket", "block", "guest", "node", "part", "small", "h")
    return mapped(full.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "guest"), run, "a long, b long")


def node_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, h): the shingle sets of documents named in ``wanted`` (node), 64-bit hashes in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, data, bounds in sliced(*utf8(b.column(1))):
                h, at = shingle_sets(data, bounds, shingle)
                raw = pa.array([h[s:e].tobytes() for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, last - first), raw], ["node", "h"])

    some = docs.select(F.col("doc_id").alias("node"), "text").join(sized(wanted), "node", "left_semi")
    return mapped(some, run, "node long, h binary")


def verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of the written ``pairs`` (a, b) whose whole shingle sets are as similar.

    The set of ``a`` is sent once for up to PAIRS_OF_SET pairs or so, and held while theirs stream by.
    """
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = written(node_sets(docs, written(ends, "ends"), shingle), "sets")
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_OF_SET).cast("int").alias("salts"))
    salted = pairs.join(many, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
    first = sets.withColumnRenamed("node", "a").join(salted.select("a", "salt").distinct(), "a")
    first = first.select("a", "salt", F.lit(None).cast("long").alias("b"), "h")
    second = sets.withColumnRenamed("node", "b").join(salted.select("a", "salt", "b"), "b").select("a", "salt", "b", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, mine = None, []
        for t in batches:
            a, salt, b = (t.column(i).to_pylist() for i in range(3))
            good = []
            for i, raw in enumerate(t.column(3)):
                h = np.frombuffer(raw.as_buffer(), np.uint64)
                if (a[i], salt[i]) != key:
                    key, mine = (a[i], salt[i]), []
                if b[i] is None:
                    mine.append(h.copy())
                elif any(similar(x, h, percent) for x in mine):
                    good.append(i)
            yield t.select(["a", "b"]).take(pa.array(good, pa.int64()))

    both = first.unionByName(second).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return mapped(both, run, "a long, b long")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two ordered sets share ``percent`` of a hundred of their union; an empty one shares nothing."""
    if not len(x) or not len(y) or not _may(np.int64(len(x)), np.int64(len(y)), percent):
        return False
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def linked_parts(docs: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, part) of every node that is linked, over one or more links, to another."""
    rows = written(shared_buckets(nodes), "shared")
    pairs = written(leader_pairs(rows, nodes, percent), "pairs")
    led = written(verified(pairs, docs, shingle, percent), "led")
    parts = written(components(led).select("node", F.col("component").alias("part")), "parts")
    likely = written(likely_rows(visits(rows, nodes, parts), percent), "likely")
    sets = node_sets(docs, written(likely.select("node").distinct(), "ends"), shingle)
    links = led.union(written(visited(likely, sets, percent), "links"))
    return written(components(links).select("node", F.col("component").alias("part")), "parts")


def near_duplicate_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id long, text).

    Documents are linked where their sets of distinct word shingles share ``percent`` of a hundred of
    their union; component_id is the smallest doc_id reachable, itself included, and kept
    says whether that is the row's own.  Lower-cases A-Z; words are runs of anything but
    ``[\\x20\\x09-\\x0D]``.  A text of fewer words is one shingle.  Null, empty and blank texts have no
    shingle and no link.  Equal texts, however many, are linked.  Rows without doc_id
    keep a null component, are kept, and link nothing.  Rows that share a doc_id are one document,
    linked by any of its texts.  Other columns, whatever their names, are not read; an empty table
    gives no rows.  Shingles are compared by 64-bit hashes, whole sets are called equal by 128.
    """
    table = written(signed_documents(docs, shingle, bands, rows), "signed")
    sets = table.where("doc_id is not null and digest is not null")
    nodes = sets.groupBy("digest").agg(F.min(F.struct("doc_id", "n", "bands", "sketch")).alias("x"))
    nodes = written(nodes.select("digest", F.col("x.doc_id").alias("node"), "x.n", "x.bands", "x.sketch"), "nodes")
    parts = linked_parts(docs.where("doc_id is not null"), nodes, shingle, percent)

    # A document of several texts belongs to all of their nodes.
    ids = sets.select("doc_id", "digest").join(nodes.select(F.col("digest").alias("d"), "node"), F.col("digest") == F.col("d"))
    ids = ids.join(sized(parts), "node", "left").select("doc_id", F.coalesce("part", "node").alias("part")).distinct()
    ids = written(ids, "ids")
    twice = written(ids.groupBy("doc_id").agg(F.min("part").alias("low"), F.max("part").alias("part")).where("low < part"), "twice")
    if not twice.isEmpty():
        bridges = twice.select(F.col("low").alias("a"), F.col("part").alias("b"))
        every = ids.join(sized(twice.select("doc_id", "low")), "doc_id").select(F.col("low").alias("a"), F.col("part").alias("b"))
        joined = written(components(bridges.union(every)).select(F.col("node").alias("part"), "component"), "bridged")
        ids = ids.join(sized(joined), "part", "left").select("doc_id", F.coalesce("component", "part").alias("part")).distinct()
    found = table.join(ids.select(F.col("doc_id").alias("own"), "part"), F.col("doc_id") == F.col("own"), "left")
    component = F.coalesce("part", "doc_id")
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
