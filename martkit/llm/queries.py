"""The registered query of each operator, and its SQL for DuckDB where SQL can express it."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from .archives import archived_pages
from .common import table
from .contamination import contained_items
from .exact_dedup import exact_duplicates
from .licences import license_labels
from .merkle import tampered_proofs
from .mixing import mixed_documents
from .oracles import ORACLES  # noqa: F401
from .prefix_trie import rebuilt_trie
from .quality import quality_scores
from .secrets import secret_spans
from .simhash import linked_components
from .token_files import tokenised
from .tool_calls import TOOLS, calls_of, linked_calls
from .toxicity import toxicity_scores


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    calls, results = calls_of(table(spark, folder, "conversations"))
    return linked_calls(calls, results, TOOLS).withColumn("errors", F.array_join("errors", "; "))


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_spans(table(spark, folder, "documents"))


def op4_arc_to_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archived_pages(table(spark, folder, "pages"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = linked_components(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    return license_labels(table(spark, folder, "documents"))


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixed_documents(table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return tampered_proofs(table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return rebuilt_trie(table(spark, folder, "conversations"))


def op13_token_planes(spark: SparkSession, folder: str) -> DataFrame:
    return tokenised(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontamination, op2_tool_calls, op3_secrets, op4_arc_to_warc, op5_simhash, op6_licences, op7_exact_dedup, op8_quality, op9_mixing, op10_toxicity, op11_merkle_manifest,
                              op12_prefix_trie, op13_token_planes)}
