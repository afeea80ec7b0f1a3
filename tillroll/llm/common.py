"""Helpers shared by the operators: words, let-binding, row identity, scratch tables."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.joins import pinned
from tillroll.session import scratch_path

# Words are maximal runs of anything but ASCII white space (a contract's fixed value).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

# Rows up to which a derived table (sources, groups, windows of a benchmark) is broadcast;
# the count is checked on the written table, beyond it the join shuffles.
BROADCAST_ROWS = 500_000


def ship(module: str) -> None:
    """Send this module's functions to the workers by value, so executors need no copy of the
    library on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def handed_up(df: DataFrame, inner: list[str], outer: list[str]) -> DataFrame:
    """``df`` written to the shared folder so that it outlives the inner of two scratch scopes."""
    path = scratch_path(df.sparkSession, "kept")
    df.write.parquet(path)
    inner.remove(path)
    outer.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` with ``value`` evaluated once per row, also when the body uses
    it inside lambdas (a plain column expression would be inlined there)."""
    return F.transform(F.array(value), body)[0]


def text_of(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def split_words(text: Column) -> Column:
    """The words of a text in order; no words: an empty array."""
    return F.filter(F.split(text, SPACE, -1), lambda w: w != "")


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def count_chars(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def row_key(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two non-null longs that name a row by its id and text, for joins that also hold for
    null ids. Rows equal in both are repeats of each other and share every decision."""
    return [
        F.xxhash64(df[doc_id].cast("string")).alias("_rk"),
        F.xxhash64(df[text]).alias("_tk"),
    ]


def broadcast_checked(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Write ``small`` to the shared folder; broadcast it only if its count allows."""
    small = pinned(small)
    return F.broadcast(small) if small.limit(max_rows + 1).count() <= max_rows else small


def without_rows(docs: DataFrame, gone: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose :func:`row_key` is in ``gone``, columns unchanged."""
    gone = broadcast_checked(gone.select(F.col("_rk").alias("_gone_rk"), F.col("_tk").alias("_gone_tk")))
    rk, tk = row_key(docs, doc_id, text)
    return docs.join(gone, (rk == F.col("_gone_rk")) & (tk == F.col("_gone_tk")), "left_anti")
