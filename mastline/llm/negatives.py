"""Hard negatives by inner product, searched for in cover trees over norm-augmented candidates.

A further component gives all candidates of a tree one norm, so the inner product with an
anchor falls as the Euclidean distance grows.  Each node of a cover tree has a centre and a
covering radius, which bound the inner products of everything below it from both sides.  A
best-first descent opens the nodes with the highest bounds, skips those that lie outside all
of an anchor's score windows or below what it has found, and scores leaves exactly.

Candidates are dealt by a hash to trees of bounded size; the trees are written once.  Anchors go
to all trees in blocks of bounded size.  A tree returns a few rows per anchor and window.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mastline.llm.common import mapped, written

TREE_ROWS = 4096  # candidates of a tree
BLOCK_ROWS = 8192  # anchors that are sent to all trees at once
LEAF = 64  # candidates up to which a node is a leaf
SHRINK = 0.85  # radius of a level by that of the level above
BEAM = 32  # nodes opened at once, the best first; more where these are small:
BEAM_ROWS = 512  # children and rows of the nodes opened at once
_ANY = 1 << 62
_EXACT = 2.0**53  # doubles add whole numbers exactly below this


class CoverTree:
    """Whole-number vectors (n, width) with their ids and labels, in nodes of falling covering radius.

    Centres of a level lie further apart than the level's radius and every vector lies within
    it of one of them; ``radius`` holds what is really needed.  Children of a node, and
    the vectors of a leaf, are neighbours in their arrays.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        x = vectors.astype(np.float64)
        square = (x * x).sum(1)
        self.square = float(square.max(initial=0.0))
        lift = np.sqrt(np.maximum(0.0, self.square - square))  # the augmenting component
        order: list[np.ndarray] = []
        nodes = [[0, 0.0, 0, 0, True]]  # centre, radius, first, last + 1, leaf
        todo = [(0, np.arange(len(ids)))]
        placed = 0
        for node, members in todo:
            centre = nodes[node][0]
            away = self._away(x, lift, members, centre)
            radius = float(away.max(initial=0.0))
            nodes[node][1] = radius
            if len(members) <= LEAF or radius == 0:
                nodes[node][2:] = placed, placed + len(members), True
                order.append(members)
                placed += len(members)
                continue
            nodes[node][2:] = len(nodes), 0, False
            for middle, part in self._net(x, lift, members, centre, away, radius * SHRINK):
                todo.append((len(nodes), part))
                nodes.append([middle, 0.0, 0, 0, True])
            nodes[node][3] = len(nodes)
        row = np.concatenate(order) if len(ids) else np.zeros(0, np.int64)
        self.ids, self.labels, self.vectors = ids[row], labels[row], vectors[row]
        self.centre = vectors[[c for c, *_ in nodes]] if len(ids) else vectors
        self.radius = np.array([r for _, r, *_ in nodes])
        self.first, self.last = (np.array([n[i] for n in nodes], np.int64) for i in (2, 3))
        self.leaf = np.array([n[4] for n in nodes])
        # The labels below a node, as a range: all that a skip by label needs to know.
        self.low, self.high = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        for n in range(len(nodes) - 1, -1, -1) if len(ids) else ():
            below = slice(self.first[n], self.last[n])
            low, high = (self.labels, self.labels) if self.leaf[n] else (self.low, self.high)
            self.low[n], self.high[n] = low[below].min(), high[below].max()

    @staticmethod
    def _away(x: np.ndarray, lift: np.ndarray, members: np.ndarray, centre: int) -> np.ndarray:
        gap = x[members] - x[centre]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap) + (lift[members] - lift[centre]) ** 2)

    def _net(self, x, lift, members, centre, away, radius) -> list[tuple[int, np.ndarray]]:
        """Centres further than ``radius`` apart, farthest first, and the members nearest to each; the first is ``centre``."""
        mid, near, owner = [centre], away.copy(), np.zeros(len(members), np.int64)
        while near.max() > radius:
            new = int(near.argmax())
            mid.append(int(members[new]))
            d = self._away(x, lift, members, mid[-1])
            closer = d < near
            owner[closer], near[closer] = len(mid) - 1, d[closer]
        by = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[by], np.arange(len(mid) + 1))
        return [(m, members[by[s:e]]) for m, s, e in zip(mid, cuts[:-1], cuts[1:], strict=True)]

    def packed(self) -> bytes:
        state = dict(self.__dict__)
        for name in ("vectors", "centre"):
            v = state[name]
            state[name] = v.astype(np.int16) if v.size and abs(v).max() < 1 << 15 else v
        return pickle.dumps(state, pickle.HIGHEST_PROTOCOL)

    @classmethod
    def unpacked(cls, raw: bytes) -> CoverTree:
        tree = cls.__new__(cls)
        tree.__dict__.update(pickle.loads(raw))
        for name in ("vectors", "centre"):
            setattr(tree, name, getattr(tree, name).astype(np.int64))
            setattr(tree, f"{name}_near", getattr(tree, name).astype(np.float64))
        return tree

    def search(self, query: np.ndarray, label: int, same: bool, skip: int, low: np.ndarray, high: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window (scores from ``low`` to ``high``) the first ``k`` (ids, scores), highest score first, then smallest id.

        Only candidates of the same label, or only those of another; never the one with id ``skip``.
        """
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in low]
        if not len(self.ids):
            return found
        query = query.astype(np.int64)
        width = min(len(query), self.vectors.shape[1])  # a missing component counts as zero
        q = query[:width]
        size = float((query.astype(np.float64) ** 2).sum())
        exact = np.sqrt(size * self.square) < _EXACT
        points = self.vectors_near[:, :width] if exact else self.vectors[:, :width]
        asked = q.astype(np.float64) if exact else q
        middle, half = self.centre_near[:, :width], q.astype(np.float64)
        slack = 1e-7 * (size + self.square) + 1e-6
        floor = low.astype(np.int64).copy()  # what a score has to reach, per window

        def bounds(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at, r = middle[nodes] @ half, self.radius[nodes]
            d = np.sqrt(np.maximum(0.0, size + self.square - 2 * at))
            top = np.minimum((size + self.square - np.maximum(0.0, d - r) ** 2) / 2, at + np.sqrt(size) * r)
            bottom = np.maximum((size + self.square - (d + r) ** 2) / 2, at - np.sqrt(size) * r)
            return top + slack, bottom - slack

        def labelled(nodes: np.ndarray) -> np.ndarray:
            a, b = self.low[nodes], self.high[nodes]
            return (a <= label) & (label <= b) if same else (a != label) | (b != label)

        front = np.zeros(1, np.int64)
        top, bottom = bounds(front)
        while True:
            open_ = ((top[:, None] >= floor) & (bottom[:, None] <= high)).any(1)
            front, top, bottom = front[open_], top[open_], bottom[open_]
            if not len(front):
                return found
            best = np.argsort(-top, kind="stable")
            held = np.cumsum(self.last[front[best]] - self.first[front[best]])
            best = best[: max(BEAM, int(np.searchsorted(held, BEAM_ROWS)))]
            opened = front[best]
            rest = np.ones(len(front), bool)
            rest[best] = False
            leaf = self.leaf[opened]
            children = _ranges(self.first[opened[~leaf]], self.last[opened[~leaf]])
            children = children[labelled(children)]
            more = bounds(children)
            front, top, bottom = (np.concatenate([x[rest], y]) for x, y in ((front, children), (top, more[0]), (bottom, more[1])))
            row = _ranges(self.first[opened[leaf]], self.last[opened[leaf]])
            row = row[((self.labels[row] == label) == same) & (self.ids[row] != skip)]
            if not len(row):
                continue
            score = (points[row] @ asked).astype(np.int64)
            for w in range(len(floor)):
                hit = np.flatnonzero((score >= floor[w]) & (score <= high[w]))
                if len(hit) > k:  # ties with the last of the first k stay until the ids decide
                    hit = hit[score[hit] >= np.partition(score[hit], -k)[-k]]
                if len(hit):
                    i, s = np.concatenate([found[w][0], self.ids[row[hit]]]), np.concatenate([found[w][1], score[hit]])
                    order = np.lexsort((i, -s))[:k]
                    found[w] = i[order], s[order]
                    if len(order) == k:
                        floor[w] = max(floor[w], s[order[-1]])


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    many = last - first
    return np.arange(many.sum()) + np.repeat(first - np.cumsum(many) + many, many)


def _dense(column: pa.Array) -> np.ndarray:
    """Lists of whole numbers as rows of one width, short ones filled with zeros."""
    size = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(size), max(1, int(size.max(initial=1)))), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def trees(rows: DataFrame, per_tree: int = TREE_ROWS) -> DataFrame:
    """(tree binary): all ``rows`` (vec_id long, label int, vector array<long>) in cover trees of about ``per_tree`` rows.

    Of rows that share a vec_id the smallest by label and vector counts.
    """
    shards = max(1, -(-rows.count() // per_tree))

    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, labels = (group.column(i).to_numpy().astype(np.int64) for i in (1, 2))
        column = group.column(3).combine_chunks()
        vectors = _dense(column.chunk(0) if isinstance(column, pa.ChunkedArray) else column)
        order = np.lexsort((*vectors.T[::-1], labels, ids))
        keep = order[np.append(True, ids[order][1:] != ids[order][:-1])]
        return pa.table({"tree": pa.array([CoverTree(ids[keep], labels[keep], vectors[keep]).packed()], pa.binary())})

    dealt = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), "vec_id", "label", "vector")
    return dealt.groupBy("shard").applyInArrow(build, "tree binary")


def _blocks(rows: DataFrame, per_block: int) -> tuple[DataFrame, int]:
    n = max(1, -(-rows.count() // per_block))
    return rows.withColumn("block", F.pmod(F.xxhash64("anchor_id", F.lit(1)), F.lit(n)).cast("int")), n


def _asked(forest: DataFrame, asked: DataFrame, blocks: int, look, schema: str) -> DataFrame:
    """``look(tree, anchor_id, label, vector, scores)`` for every tree and row of ``asked``, block by block."""

    def one(k: int) -> DataFrame:
        table = asked.where(F.col("block") == k).toArrow()  # BLOCK_ROWS or so
        sent = forest.sparkSession.sparkContext.broadcast(pickle.dumps(table))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pickle.loads(sent.value)
            ids, labels, scores = (t.column(c).to_pylist() for c in ("anchor_id", "label", "scores"))
            vectors = [np.array(v, np.int64) for v in t.column("vector").to_pylist()]
            for b in batches:
                for raw in b.column(0):
                    tree = CoverTree.unpacked(raw.as_py())
                    rows = [r for a in zip(ids, labels, vectors, scores, strict=True) for r in look(tree, *a)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 4, ["anchor_id", "key", "other_id", "score"])

        return mapped(forest, run, schema)

    return reduce(DataFrame.union, [one(k) for k in range(blocks)])


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors among ``rows``.

    ``rows`` (vec_id long, label int, vector array<long>) have neither nulls nor labels out of an
    int; scores are inner products and have to fit a long.  An anchor's positives are its first
    rows of the same label, highest score first, ties by smaller vec_id; its negatives for each
    positive are the first rows of other labels whose score is ``low`` to ``high`` hundredths of the
    positive's.  Fewer are returned where there are fewer; an anchor without positives or
    negatives gives no row.  Rows that repeat a vec_id count once (the smallest by label and vector), and
    none is its own positive.  A component that a shorter vector lacks counts as zero.
    """
    forest = written(trees(rows), "trees")
    anchors = rows.where(is_anchor).groupBy(F.col("vec_id").alias("anchor_id")).agg(F.min(F.struct("label", "vector")).alias("x"))
    anchors, blocks = _blocks(written(anchors.select("anchor_id", "x.label", "x.vector"), "anchors"), BLOCK_ROWS)
    schema = "anchor_id long, key long, other_id long, score long"

    def nearest(tree: CoverTree, anchor: int, label: int, vector: np.ndarray, _) -> Iterator[tuple]:
        ((ids, scores),) = tree.search(vector, label, True, anchor, np.array([-_ANY]), np.array([_ANY]), positives)
        return ((anchor, 0, i, s) for i, s in zip(ids.tolist(), scores.tolist(), strict=True))

    same = _asked(forest, anchors.withColumn("scores", F.lit(None).cast("array<long>")), blocks, nearest, schema)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    chosen = same.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    chosen = written(chosen.select("anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    def within(tree: CoverTree, anchor: int, label: int, vector: np.ndarray, scores: list[int]) -> Iterator[tuple]:
        top = np.array([high * s // 100 for s in scores])
        found = tree.search(vector, label, False, anchor, np.array([-(-low * s // 100) for s in scores]), top, negatives)
        return ((anchor, p, i, s) for p, (ids, got) in zip(scores, found, strict=True) for i, s in zip(ids.tolist(), got.tolist(), strict=True))

    windows = chosen.groupBy("anchor_id").agg(F.collect_set("positive_score").alias("scores"))  # ``positives`` at most
    other = _asked(forest, written(anchors.join(windows, "anchor_id"), "windows"), blocks, within, schema)
    first = Window.partitionBy("anchor_id", "key").orderBy(F.desc("score"), "other_id")
    ranked = other.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    ranked = ranked.select("anchor_id", F.col("key").alias("positive_score"), "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return chosen.join(ranked, ["anchor_id", "positive_score"]).select(*out)


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, vector): components as floor(scale * x); rows with a null or non-finite part are left out."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    full = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * float(scale)).cast("long"))
    return full.select("vec_id", "label", vector.alias("vector"))


def negatives_report(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh label is first moved on by one of ten."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(quantised(embeddings).withColumn("label", label), F.col("vec_id") % 100 == 0)
