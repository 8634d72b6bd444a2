"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastline.llm.common import written

ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node; a component is named by its smallest node.

    ``links`` (a, b) may repeat, be in either direction and hold loops.  Each round rewires
    neighbours to the smallest node around (large star: the larger ones, small star: the
    others) and is written to the shared folder; the number of rounds grows with the
    logarithm of the longest path.  Minima are combined map-side, and the join back
    is one that adaptive execution can split, so a node with very many links
    does not end up in one task.
    """
    ends = (F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(links.where(F.col("a") != F.col("b")).select(*ends).distinct(), "links")
    state = _state(edges)
    for _ in range(ROUNDS):
        if state[0] == 0:
            break
        edges = written(_small_star(_large_star(edges)), "stars")
        after = _state(edges)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    h = F.xxhash64("a", "b")
    row = edges.agg(F.count("*"), F.sum(F.shiftright(h, 24)), F.sum(F.expr("xxhash64(b, a) >> 24"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return low.select("a", F.col("m").alias("b")).union(rest).distinct()
