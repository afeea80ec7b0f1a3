"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept;
its output is written as Parquet in the shared folder and read again as the next one's
input. All but the last return the columns of ``documents``.

Defined results: documents with a null or empty text, or few words, go with the quality rules; a
null id, language or source is kept as it is and groups with its like; of repeated rows one
stays; further columns, of any name, stay up to the last stage; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import histogram_shard, order_minhash, pivotal_mix, quality_rules, template_decontaminate
from tillroll.llm.common import table
from tillroll.operators.joins import pinned


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one of least id."""
    return order_minhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of the benchmark stands."""
    return template_decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: each document as often as it is taken, none up to twice."""
    return pivotal_mix.mix_copies(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each document of the mix."""
    return histogram_shard.report(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

# The near-duplicate, mixing and sharding stages can't be written as one SQL statement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
