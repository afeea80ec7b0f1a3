"""The registered queries of the operators: one per operator, with production parameters,
over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (
    chat_format,
    curve_clusters,
    histogram_shard,
    kernel_language,
    order_minhash,
    pivotal_mix,
    prefix_tokens,
    private_data,
    quality_rules,
    secret_scan,
    template_decontaminate,
    token_alignment,
    url_filter,
)
from tillroll.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets per document; models trained on samples of the documents."""
    docs = table(spark, sf_dir, "documents")
    return secret_scan.report(docs, secret_scan.train(secret_scan.corpus_samples(docs)))


def op2_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of each document, whether it exceeds the limit and where to cut it."""
    return prefix_tokens.report(table(spark, sf_dir, "documents"))


def op3_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learned from those that are not held out."""
    return kernel_language.report(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and conversation -1, read back from their format."""
    return chat_format.report(chat_format.with_extra(table(spark, sf_dir, "conversations")))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of each document."""
    return order_minhash.report(table(spark, sf_dir, "documents"))


def op6_template_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that stand in documents: one row per document and item."""
    return template_decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of each document."""
    return quality_rules.report(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of each page's URL."""
    return url_filter.report(table(spark, sf_dir, "pages"))


def op9_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return pivotal_mix.report(table(spark, sf_dir, "documents"))


def op10_histogram_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document."""
    return histogram_shard.report(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' encodings of each document."""
    return token_alignment.report(table(spark, sf_dir, "documents"))


def op12_curve_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of each vector after three rounds."""
    return curve_clusters.report(table(spark, sf_dir, "embeddings"))


def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data per document."""
    return private_data.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_prefix_tokens,
        op3_kernel_language,
        op4_chat_format,
        op5_order_minhash,
        op6_template_decontaminate,
        op7_quality_rules,
        op8_url_filter,
        op9_pivotal_mix,
        op10_histogram_shard,
        op11_token_alignment,
        op12_curve_clusters,
        op13_private_data,
    )
}

# SQL of the queries that SQL can express; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op4_chat_format": chat_format.ORACLE,
    "op8_url_filter": url_filter.ORACLE,
    "op12_curve_clusters": curve_clusters.oracle(),
}
