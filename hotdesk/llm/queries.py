"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hotdesk.llm import (
    conversation_repair,
    decontaminate,
    exact_search,
    language_id,
    ngram_join,
    packing,
    pii,
    quality,
    reply_trees,
    secret_scan,
    sharding,
    spelling,
    token_output,
)
from hotdesk.llm.oracle import ORACLE
from hotdesk.llm.tables import read

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def over(table: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(read(spark, sf_dir, table))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_cost_balanced_packing": over("documents", packing.digest),
    "op2_ngram_jaccard_join": over("documents", ngram_join.digest),
    "op3_secret_ownership": over("documents", secret_scan.digest),
    "op4_partial_matching_language": over("documents", language_id.identify),
    "op5_balanced_label_propagation": over("documents", sharding.digest),
    "op6_personal_data": over("documents", pii.digest),
    "op7_co_training_quality": _quality,
    "op8_aligned_decontamination": _leaks,
    "op9_packed_matrices": over("documents", token_output.matrices),
    "op10_exact_top_k": over("embeddings", exact_search.nearest),
    "op11_conversation_repair": over("conversations", conversation_repair.digest),
    "op12_reply_trees": over("conversations", reply_trees.digest),
    "op13_spelling_variants": over("documents", spelling.digest),
}
