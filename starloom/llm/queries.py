"""The training-data queries and their DuckDB SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom.llm import oracle
from starloom.llm.byte_bpe import op3_byte_bpe
from starloom.llm.common import table
from starloom.llm.jaccard_join import op7_jaccard_join
from starloom.llm.mixing import op11_mixing
from starloom.llm.packing import op8_packing
from starloom.llm.prefix_trie import op12_prefix_trie
from starloom.llm.quality_classifier import op5_quality_classifier
from starloom.llm.quality_rules import op4_quality_rules
from starloom.llm.token_alignment import op13_token_alignment
from starloom.llm.token_counts import op1_token_counts
from starloom.llm.token_files import op10_token_files
from starloom.llm.topk_search import op9_topk_search
from starloom.llm.toxicity import op2_toxicity
from starloom.llm.url_filters import op6_url_filters

Query = Callable[[SparkSession, str], DataFrame]


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = public_tokenizers.path("byte_bpe_50k.json")
    return op1_token_counts(spark, table(spark, sf_dir, "documents"), definition, public_tokenizers.PATTERN)


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return op3_byte_bpe(spark, table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_quality_rules(spark, table(spark, sf_dir, "documents"))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_quality_classifier(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_url_filters(spark, table(spark, sf_dir, "pages"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_jaccard_join(spark, table(spark, sf_dir, "documents"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = public_tokenizers.path("byte_bpe_50k.json")
    return op8_packing(spark, table(spark, sf_dir, "documents"), definition, public_tokenizers.PATTERN)


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_topk_search(spark, table(spark, sf_dir, "embeddings"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_token_files(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_mixing(spark, table(spark, sf_dir, "documents"))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_prefix_trie(spark, table(spark, sf_dir, "conversations"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition, model = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return op13_token_alignment(spark, table(spark, sf_dir, "documents"), definition, model, public_tokenizers.PATTERN)


QUERIES: dict[str, Query] = {
    "op1_token_counts": _op1,
    "op2_toxicity": _op2,
    "op3_byte_bpe": _op3,
    "op4_quality_rules": _op4,
    "op5_quality_classifier": _op5,
    "op6_url_filters": _op6,
    "op7_jaccard_join": _op7,
    "op8_packing": _op8,
    "op9_topk_search": _op9,
    "op10_token_files": _op10,
    "op11_mixing": _op11,
    "op12_prefix_trie": _op12,
    "op13_token_alignment": _op13,
}

ORACLE_SQL: dict[str, str] = dict(oracle.ORACLE_SQL)
