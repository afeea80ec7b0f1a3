"""Distinct counts from bitmaps against Spark's distinct count."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillroll.operators.distinct import bitmaps, count_members, dense_ids, merged
from tillroll.plans.pipeline import fact_table


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("limit", [1_000_000, 0], ids=["broadcast", "shuffled"])
def test_counts_of_every_coarser_grouping_equal_distinct_counts(spark, sf_small, limit):
    fact = fact_table(spark, sf_small)
    sets = bitmaps(fact, "customer_id", ("year", "month", "city"), max_broadcast_rows=limit).cache()
    for keys in (("year", "month", "city"), ("city",), ("year", "month"), ("year",), ()):
        want = fact.groupBy(*keys).agg(F.count_distinct("customer_id").alias("n"))
        assert _rows(count_members(sets, keys)) == _rows(want), keys
    some = sets.where("city = 'NATION_3' and year = 1996")
    assert count_members(some).first().n == fact.where("city = 'NATION_3' and year = 1996").agg(F.count_distinct("customer_id")).first()[0]


def test_more_values_than_a_bitmap_nulls_and_no_rows(spark):
    rows = spark.range(100_000).select(
        F.concat(F.lit("c"), F.col("id") % 70_000).alias("c"), (F.col("id") % 3).alias("g")
    ).union(spark.createDataFrame([(None, 7), (None, None), ("c1", None)], "c string, g long"))
    sets = bitmaps(rows, "c", ("g",))
    want = rows.groupBy("g").agg(F.count_distinct("c").alias("n"))
    assert _rows(count_members(sets, ("g",))) == _rows(want)
    assert count_members(sets).first().n == 70_000
    assert dense_ids(rows, "c").agg(F.count_distinct("_id")).first()[0] == 70_000
    none = bitmaps(rows.limit(0), "c", ("g",))
    assert count_members(none, ("g",)).count() == 0 and count_members(none).first().n == 0


def test_later_rows_merge_with_stored_sets(spark):
    rows = spark.range(5_000).select((F.col("id") % 900).cast("string").alias("c"), (F.col("id") % 2).alias("g"))
    ids = dense_ids(rows, "c")
    parts = [bitmaps(rows.where(p), "c", ("g",), ids) for p in ("c < '5'", "c >= '3'")]
    both = merged(parts[0].union(parts[1]), ("g",))
    assert _rows(count_members(both, ("g",))) == _rows(rows.groupBy("g").agg(F.count_distinct("c").alias("n")))
