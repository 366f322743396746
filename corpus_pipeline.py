"""The corpus pipeline: toxic documents go, documents that fail the quality rules go, one
document of each group of near copies stays, and what is left is packed into sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom.llm import jaccard_join, packing, quality_rules, toxicity
from starloom.llm.common import small_batches, table
from starloom.session import scratch_path

#: What a worker remembers of tokenized pieces, beside what the stages before have left in memory.
MEMO_BYTES = 90_000_000


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; the model learns from the labels of ``docs``."""
    small_batches(spark)
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and their group's adaptive fences."""
    small_batches(spark)
    return quality_rules.accepted(docs)


def dedupe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each component of near copies."""
    small_batches(spark)
    return jaccard_join.one_per_group(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 1024 ids."""
    small_batches(spark)
    return packing.op8_packing(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, MEMO_BYTES)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("jaccard_join", dedupe_stage),
    ("packing", packing_stage),
]

#: No SQL expresses a trained model or a tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every earlier stage is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
