"""A training corpus from `documents`: quality, exact copies, near copies, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read
again as the next stage's docs.  All but the last give the columns of documents.  SQL can't express
the classifier; the tests hold run() against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.exact import drop_exact_copies
from ledgerline.llm.near import drop_near_copies
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.passages import cut_passages
from ledgerline.llm.quality import drop_low_quality
from ledgerline.session import kept

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, doesn't reject."""
    return drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies the document with the smallest doc_id."""
    return drop_near_copies(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller doc_id holds."""
    return cut_passages(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
    return docs
