"""Exact distinct counts that can be merged: bitmaps over dense ids.

Counts of distinct values don't add up over groups, sets do. Each value gets a number, a group's
values are bits of bitmaps of 32,768 numbers each (``bitmap_construct_agg``, pre-aggregated in
the map tasks), and the bitmaps of finer groups are merged into those of any coarser grouping
(``bitmap_or_agg``) without the rows. A stored table of them has at most a row of 4 KB per group
and 32,768 values, however many rows stand behind it, so its grain should be one whose groups
hold many of the values.

Nulls are not counted; a group without a value has the count 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.joins import DEFAULT_BROADCAST_ROWS, broadcast_if_small, pinned


def dense_ids(df: DataFrame, column: str) -> DataFrame:
    """``column`` and ``_id``, a number per distinct value that runs without gaps in each part of
    the table. It is written, so the numbers stay; no task sees all values."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return pinned(values.withColumn("_id", F.monotonically_increasing_id()))


def bitmaps(
    df: DataFrame, column: str, keys: Sequence[str], ids: DataFrame | None = None, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
) -> DataFrame:
    """``keys``, ``_bucket`` and ``_bits``: the sets of ``column`` in each group. ``ids`` is the
    numbering of an earlier call, to merge with its bitmaps; it must hold all values. It is
    broadcast behind a row count, beyond it the narrow rows are joined by the value."""
    ids = dense_ids(df, column) if ids is None else ids
    numbered = df.select(*keys, column).join(broadcast_if_small(ids, max_broadcast_rows, pin=False), column, "left")
    return numbered.groupBy(*keys, F.bitmap_bucket_number("_id").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("_bits")
    )


def merged(sets: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The sets of a coarser grouping, as :func:`bitmaps` would give them."""
    return sets.groupBy(*keys, "_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits"))


def count_members(sets: DataFrame, keys: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Exact number of distinct values per group of ``keys``, any of those of ``sets``."""
    counted = merged(sets, keys).select(*keys, F.bitmap_count("_bits").alias("_c"))
    return counted.groupBy(*keys).agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias(name))
