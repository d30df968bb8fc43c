"""The queries of this package, one for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opstelemetry.llm import centroids, decontam, mixing, near_vectors, prefix_trie
from opstelemetry.llm.chat import events_of, formatted, tool_table
from opstelemetry.llm.decontam import contaminated
from opstelemetry.llm.licenses import scanned
from opstelemetry.llm.mixing import mixed
from opstelemetry.llm.quality import judged
from opstelemetry.llm.repeats import without_repeats
from opstelemetry.llm.secrets import digest
from opstelemetry.llm.simhash import near_duplicates
from opstelemetry.llm.suffix_tree import scored
from opstelemetry.llm.token_counts import token_counts

TOKENIZER_FILE = "byte_bpe_50k.json"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    return formatted(events_of(spark.read.parquet(f"{sf}/conversations.parquet")), tool_table(spark))


def op2_suffix_tree_scores(spark: SparkSession, sf: str) -> DataFrame:
    return scored(documents(spark, sf))


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(documents(spark, sf), public_tokenizers.path(TOKENIZER_FILE))


def op4_mixing_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixed(documents(spark, sf)).select("doc_id", "size", "source_size", "target", "taken")


def op5_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    return scanned(documents(spark, sf)).drop("spans")


def op6_repeated_strings(spark: SparkSession, sf: str) -> DataFrame:
    return without_repeats(documents(spark, sf)).drop("spans")


def op7_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(documents(spark, sf))


def op9_secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    return digest(documents(spark, sf))


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged(documents(spark, sf)).select("doc_id", *columns, "base_failed", "kept", "failed_rule")


def op11_conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf}/conversations.parquet"))


def op12_centroid_clustering(spark: SparkSession, sf: str) -> DataFrame:
    return centroids.clustered(spark.read.parquet(f"{sf}/embeddings.parquet"))


def op13_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors.near_duplicates(spark.read.parquet(f"{sf}/embeddings.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_formatting": op1_chat_formatting,
        "op2_suffix_tree_scores": op2_suffix_tree_scores,
        "op3_token_counts": op3_token_counts,
        "op4_mixing_sources": op4_mixing_sources,
        "op5_license_scans": op5_license_scans,
        "op6_repeated_strings": op6_repeated_strings,
        "op7_benchmark_decontamination": op7_benchmark_decontamination,
        "op8_simhash": op8_simhash,
        "op9_secret_scans": op9_secret_scans,
        "op10_quality_rules": op10_quality_rules,
        "op11_conversation_trie": op11_conversation_trie,
        "op12_centroid_clustering": op12_centroid_clustering,
        "op13_embedding_near_dedup": op13_embedding_near_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_mixing_sources": mixing.oracle_sql(),
        "op7_benchmark_decontamination": decontam.oracle_sql(),
        "op11_conversation_trie": prefix_trie.oracle_sql(),
        "op12_centroid_clustering": centroids.oracle_sql(),
        "op13_embedding_near_dedup": near_vectors.oracle_sql(),
    }
