"""A training corpus from raw documents: five stages, each written and read again by the next.

Every stage judges a row by its own whole text and keeps null and empty texts unless a stage's rule is
about them.  Rows that repeat a doc_id are told apart by their texts; of rows that repeat both, the
exact stage keeps one.  Columns, whatever their names, pass through; the last stage adds ``copies``.
Empty tables give empty ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from mastline.llm.common import shared_folder
from mastline.llm.decontaminate import drop_contaminated
from mastline.llm.exact import drop_copies
from mastline.llm.mixing import mixed_documents
from mastline.llm.simhash import drop_near_duplicates
from mastline.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; without labels none does."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space one stays: the longest, then the smallest doc_id; null and empty ones are equal."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with near fingerprints (four words, four bits) the smallest doc_id stays, null last."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark, or a passage of a long one, go; items under 24 bytes drop none."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each source (null is one), with the number of copies; rows without words go."""
    return mixed_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]
# A trained classifier and fingerprints are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
