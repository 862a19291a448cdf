"""A training corpus from raw documents: each stage works on what the one before kept.

Counted as part of tidemark.llm. Every stage takes (spark, docs, sf_dir); all but the last return the
columns of documents.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, mixing, sharding, shingles, toxicity
from tidemark.llm.common import checkpoint_dir, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word Jaccard 0.8 or more stays: that of the least doc_id."""
    return shingles.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tiles cover four fifths of a test item go."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"), 0.8)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, twice at most; every document stays at least once."""
    return mixing.schedule(docs, repetition_limit=2.0).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """24 shards of near equal bytes, equal texts together; slots follow mixing's keyed permutation, one epoch after the other."""
    return sharding.shard_documents(docs, 24, mixing.keyed(mixing.SEED, "doc_id", "text"))


STAGES = [("toxicity", toxic), ("near_duplicates", near_duplicates), ("decontamination", benchmark_leaks), ("mixing", mixed), ("sharding", sharded)]

#: SQL can't train the classifier, hash shingles with XXH64, tile, or schedule through a heap.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = f"{checkpoint_dir(spark)}/corpus-{uuid4().hex}/{k}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
