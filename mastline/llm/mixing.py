"""Mixing sources to target weights by hash-threshold histograms.

Documents get a fixed hash.  Per source, token sums by hash bucket show which bucket holds
the budget's end; only that bucket is cut into finer ones.  What is taken is then a
filter on the hash: no sort, and a larger budget takes a superset.
All of it is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mastline.llm.common import sized, written

# Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
REPEAT_LIMIT = 3
BITS = 12  # of a bucket number; the boundary bucket is cut into as many again

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"


def word_count(text: Column) -> Column:
    """Number of runs of anything but ``[\\x20\\x09-\\x0D]``; null has none.

    Each word with the white space around it becomes one letter, so no array of words is built.
    """
    squeezed = F.regexp_replace(text, f"{_SPACE}*+{_WORD}++{_SPACE}*+", "x")
    return F.when(text.rlike(_WORD), F.length(squeezed)).otherwise(0).cast("long")


def targets(sizes: DataFrame, share: float = 1.0, weights: tuple = WEIGHTS, limit: int = REPEAT_LIMIT) -> DataFrame:
    """(source, source_size, target): the budget shared by weight, no source above ``limit`` times its size.

    ``sizes`` has one row per source (source, source_size).  What a capped source leaves goes to
    the others by weight.  In order of limit * size / weight the capped sources come first,
    so running sums give each source's level.  One row per source passes one task.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    rows = sizes.withColumns({"weight": weight, "cap": (F.col("source_size") * limit).cast("double")})
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    budget = F.sum("source_size").over(every) * share
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rows = rows.withColumn("level", level)
    # The first source in this order that its level does not cap sets the level of all after it.
    found = F.when(F.col("level") <= F.col("ratio"), F.struct(F.row_number().over(order).alias("at"), "level"))
    rows = rows.withColumn("found", found).withColumn("level", F.min("found").over(every)["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return rows.select("source", "source_size", target.alias("target"))


def _boundary(sums: DataFrame, bucket: str, budget: str, keys: list) -> DataFrame:
    """Per source the bucket in which the running sum passes the budget, and what is left of the budget there."""
    run = Window.partitionBy(*keys).orderBy(bucket)
    rows = sums.withColumn("upto", F.sum("words").over(run)).where(F.col("upto") > F.col(budget))
    return rows.groupBy(*keys).agg(F.min(F.struct(bucket, (F.col(budget) - F.col("upto") + F.col("words")).alias("left"), "words")).alias("b"))


def mix(docs: DataFrame, share: float = 1.0, weights: tuple = WEIGHTS, limit: int = REPEAT_LIMIT, extra: tuple = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken): how often each document is taken.

    Every document of a source is taken ``floor(target / source_size)`` times, and once more if
    its hash is below the source's threshold.  Null text has size 0, null source is a source,
    documents without words are taken as often as the others.  Rows with one doc_id share
    a hash.  The source's taken words miss the target by at most half the words of one
    of 2^24 buckets: one document, unless some share a bucket.
    """
    hashed = F.xxhash64(F.lit("mix"), "doc_id")
    each = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.shiftrightunsigned(hashed, 64 - BITS).alias("b1"), F.shiftrightunsigned(hashed, 64 - 2 * BITS).bitwiseAND((1 << BITS) - 1).alias("b2"),
    )
    each = written(each, "sizes")

    sums = written(each.groupBy("source", "b1").agg(F.sum("size").alias("words")), "buckets")
    goal = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), share, weights, limit)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    goal = written(goal.withColumnRenamed("source", "s"), "targets")

    first = _boundary(sums.join(sized(goal), sums["source"].eqNullSafe(goal["s"])).select("s", "b1", "words", "budget"), "b1", "budget", ["s"])
    first = written(first.select(F.col("s").alias("s1"), F.col("b.b1").alias("cut1"), F.col("b.left").alias("left1")), "first-cut")

    inside = each.join(sized(first), each["source"].eqNullSafe(first["s1"]) & (each["b1"] == first["cut1"]))
    fine = inside.groupBy(F.col("s1").alias("s"), "b2", "left1").agg(F.sum("size").alias("words"))
    second = _boundary(fine, "b2", "left1", ["s"])
    # The last bucket is taken if that is nearer to the target than leaving it.
    last = F.col("b.b2") + F.when(F.col("b.left") * 2 >= F.col("b.words"), 1).otherwise(0)
    second = second.select(F.col("s").alias("s2"), last.alias("cut2"))

    plan = goal.join(first, F.col("s").eqNullSafe(F.col("s1")), "left").join(second, F.col("s").eqNullSafe(F.col("s2")), "left")
    plan = written(plan.drop("s1", "s2"), "plan")
    out = each.join(sized(plan), each["source"].eqNullSafe(plan["s"]))
    over = F.col("b1") < F.col("cut1")
    edge = (F.col("b1") == F.col("cut1")) & (F.col("b2") < F.coalesce("cut2", F.lit(1 << BITS)))
    more = F.when((F.col("budget") > 0) & (F.col("cut1").isNull() | over | edge), 1).otherwise(0)
    copies = F.col("whole") + more
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixture(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row; null and empty texts have size 0."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, with a column ``copies`` (in place of one of that name); rows without words go.

    Ties cannot arise: a document is taken by the hash of its doc_id.  Rows that repeat a doc_id and source
    are taken alike; null is a source and a doc_id like any other.  Texts are counted whole; an
    empty table stays empty.
    """
    taken = mix(docs, **options).where("taken > 0").select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("copies").alias("__copies")).distinct()
    taken = written(taken, "taken")
    ids = sized(taken)
    joined = docs.join(ids, docs["doc_id"].eqNullSafe(ids["__id"]) & docs["source"].eqNullSafe(ids["__source"]))
    kept = [c for c in docs.columns if c != "copies"]
    return joined.where(F.col("text").rlike(_WORD)).select(*[docs[c] for c in kept], F.col("__copies").alias("copies"))
