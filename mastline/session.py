"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import json
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sizes per scan split and per merged shuffle partition.  Adaptive execution only
# merges shuffle partitions; size_shuffles sets how many there are to begin with.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # A task that holds few dates writes them side by side instead of sorting by date.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def build_session(app: str = "mastline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this engine's defaults; ``conf`` keys may use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULT_CONF | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _bytes_of(spark: SparkSession, key: str) -> int:
    said = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get(key).lower())
    return int(said[1]) << (10 * " kmgt".index(said[2] or " "))


def parts_of(spark: SparkSession, input_bytes: int) -> int:
    """Partitions that an input of this size fills in a shuffle."""
    return -(-4 * input_bytes // _bytes_of(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes"))


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Make shuffles wide enough for an input of this size; results do not depend on it.

    Rows take up to some four times their CSV bytes in a shuffle, and a partition
    should hold no more than the advisory size.  Narrower than the session's own
    setting it never gets; adaptive execution merges what is too small.
    """
    wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts_of(spark, input_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wide))
    return wide


def shared_split(spark: SparkSession, sizes: list[int], least: int = 1 << 12, splits: int = 256) -> int:
    """Split size by which the largest of the files has two splits at least, and all of them have some ``splits`` or two each."""
    fair = min(max(sizes, default=0) // 2, sum(sizes) // splits)
    return max(least, min(fair, _bytes_of(spark, "spark.sql.files.maxPartitionBytes")))


@contextlib.contextmanager
def small_splits(spark: SparkSession, size: int):
    """Scans planned meanwhile have splits of at most ``size`` bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, str(size))
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    On a local master that names no such folder one is made; elsewhere that is an
    error, since executors would each write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="mastline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def small_frame(spark: SparkSession, rows: list[tuple], shape: str) -> DataFrame:
    """A handful of driver-side rows (run dates, ledger events) as a frame.

    They travel as one literal, so no Python partitions are spun up for them.
    """
    schema = T.StructType.fromDDL(shape)
    data = json.dumps([dict(zip(schema.names, row)) for row in rows])
    parsed = F.from_json(F.lit(data), T.ArrayType(schema))
    return spark.range(0, 1, 1, 1).select(F.inline(parsed))
