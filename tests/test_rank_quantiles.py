"""Skew-safe operators against brute force: per-customer rank and exact quantiles."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.functions.quantiles import column_ranges, exact_quantiles, rank_values
from tillroll.operators.rank import customer_txn_rank, frequent_customers, with_rank


def _rank_frame(spark, n_hot=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n_hot):  # one hot customer holding most rows, many per date
        rows.append(("GUEST", dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(30)), f"T{i:06d}"))
    for i in range(600):
        rows.append((f"C{rnd.randrange(50):03d}", dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(30)), f"U{i:06d}"))
    rows.append((None, dt.date(2024, 1, 2), "N1"))
    rows.append((None, None, "N2"))
    return spark.createDataFrame(rows, "customer_id string, date date, transaction_id string")


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_rank_matches_window_even_when_one_customer_spans_partitions(spark, partitions):
    df = _rank_frame(spark)
    got = customer_txn_rank(df, partitions=partitions)
    w = Window.partitionBy("customer_id").orderBy(F.col("date").asc_nulls_first(), "transaction_id")
    want = df.withColumn("cust_txn_rank", F.row_number().over(w))
    as_map = lambda d: {r.transaction_id: (r.customer_id, r.date, r.cust_txn_rank) for r in d.collect()}
    assert as_map(got) == as_map(want)


@pytest.mark.parametrize("hot_rows", [0, 5, 100, 2999])
def test_rank_with_some_customers_split_by_range(spark, hot_rows):
    """Frequent customers by range, the others by the plain window: the same ranks."""
    df = _rank_frame(spark)
    got = customer_txn_rank(df, partitions=7, hot_rows=hot_rows)
    w = Window.partitionBy("customer_id").orderBy(F.col("date").asc_nulls_first(), "transaction_id")
    want = df.select(*got.columns[:-1], F.row_number().over(w).alias("cust_txn_rank"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_frequent_customers(spark):
    df = _rank_frame(spark).union(spark.createDataFrame([(None, None, f"N{i}") for i in range(500)], "c string, d date, t string"))
    hot = {r["_hot"] for r in frequent_customers(df.repartition(9), hot_rows=400).collect()}
    assert hot == {"GUEST", None}
    assert frequent_customers(df, hot_rows=10_000).isEmpty() and frequent_customers(df.limit(0), hot_rows=0).isEmpty()


def test_rank_joins_back_to_rows_with_a_null_id(spark):
    rows = [("a", "C", dt.date(2024, 1, 2)), (None, "C", dt.date(2024, 1, 3)), ("b", "C", dt.date(2024, 1, 4)), ("c", None, None)]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, date date")
    got = {r.transaction_id: r.cust_txn_rank for r in with_rank(df, customer_txn_rank(df)).collect()}
    assert got == {"a": 1, None: 2, "b": 3, "c": 1}


def test_rank_ties_on_date_break_on_id(spark):
    df = spark.createDataFrame(
        [("C1", dt.date(2024, 1, 1), "T2"), ("C1", dt.date(2024, 1, 1), "T1"), ("C1", dt.date(2023, 1, 1), "T9")],
        "customer_id string, date date, transaction_id string",
    )
    got = {r.transaction_id: r.cust_txn_rank for r in customer_txn_rank(df).collect()}
    assert got == {"T9": 1, "T1": 2, "T2": 3}


def _disc(values, p):
    s = sorted(values)
    return s[max(1, math.ceil(p * len(s))) - 1]


def _linear(values, p):
    return float(np.quantile(np.array(sorted(values), dtype=float), p, method="linear"))


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=300),
    st.sampled_from([0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]),
)
def test_exact_quantiles_against_sorting(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x int")
    for limit in (5, 10**6):  # 5 forces brackets to be narrowed
        r = exact_quantiles(df, ["x"], [p], ["q"], method="disc", accuracy=20, max_rows=limit).first()
        assert r.n == len(values) and r.q == _disc(values, p)
        r = exact_quantiles(df, ["x"], [p], ["q"], method="linear", accuracy=20, max_rows=limit).first()
        assert r.q == pytest.approx(_linear(values, p), rel=1e-12, abs=1e-12)


def test_exact_quantiles_several_columns_one_hot_value(spark):
    rnd = random.Random(3)
    a = [7] * 5000 + [rnd.randrange(1000) for _ in range(2000)]  # one value holds most rows
    b = [rnd.random() * 100 for _ in range(len(a))]
    df = spark.createDataFrame(list(zip(a, b)), "a int, b double")
    got = {
        r.column: r
        for r in exact_quantiles(
            df, ["a", "b"], [0.1, 0.5, 0.9], ["p10", "p50", "p90"], accuracy=50, max_rows=40
        ).collect()
    }
    for col, vals in (("a", a), ("b", b)):
        assert got[col].n == len(vals)
        assert (got[col].p10, got[col].p50, got[col].p90) == tuple(float(_disc(vals, p)) for p in (0.1, 0.5, 0.9))


def test_rank_can_leave_guests_unranked(spark):
    df = _rank_frame(spark, n_hot=200)
    got = {r.transaction_id: (r.customer_id, r.cust_txn_rank) for r in customer_txn_rank(df, unranked=("GUEST",)).collect()}
    full = {r.transaction_id: r.cust_txn_rank for r in customer_txn_rank(df).collect()}
    assert len(got) == len(full)
    for tid, (cust, rank) in got.items():
        assert rank is None if cust == "GUEST" else rank == full[tid]


ODD_DOUBLES = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.0, 1.0 - 2**-53, 1.0 + 2**-52, 2.0, 2.0 - 2**-52,
               8.0, 8.0 - 2**-50, 1e300, 1.7976931348623157e308, float("inf"), float("-inf"), float("nan"), 0.1, -0.1, 1e-310, 3.0]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(), min_size=1, max_size=100))
def test_ranks_of_any_doubles(spark, values):
    values = values + ODD_DOUBLES
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(values, key=lambda v: (math.isnan(v), 0 if math.isnan(v) else v))
    ranks = {1, len(values) // 3, len(values) // 2, len(values) - 2, len(values)}
    found, _ = rank_values(df, column_ranges(df, ["x"]), {"x": ranks}, accuracy=8, max_rows=1)
    for r in ranks:
        assert repr(found["x", r] + 0.0) == repr(ordered[r - 1] + 0.0)


@pytest.mark.parametrize("kind", ["tinyint", "bigint", "float", "double", "date", "decimal(10,2)"])
def test_quantiles_of_every_kind(spark, kind):
    rnd = random.Random(8)
    raw = [rnd.randrange(-100, 100) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in raw] + [(None,)], "v int")
    df = df.select((F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("v")) if kind == "date" else (F.col("v") / 4 if "d" in kind[:3] or kind == "float" else F.col("v")).cast(kind)).alias("x"))
    values = sorted(r.x for r in df.collect() if r.x is not None)
    for p in (0.0, 0.3, 0.99, 1.0):
        r = exact_quantiles(df, ["x"], [p], ["q"], accuracy=16, max_rows=10).first()
        assert r.q == _disc(values, p) and r.n == 400
    with pytest.raises(TypeError):
        exact_quantiles(df.select(F.col("x").cast("string")), ["x"], [0.5], ["q"])


def test_scans_do_not_depend_on_the_data(spark):
    """Doubles over all magnitudes, tight clusters and one hot value: at most four scans."""
    rnd = random.Random(4)
    rows = [(rnd.choice([-1, 1]) * 2.0 ** rnd.uniform(-1000, 1000), 1.0 + rnd.randrange(3000) * 2**-52, 7.0 if i % 3 else rnd.random()) for i in range(9000)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    ranks = {c: {1, 2250, 4500, 8999} for c in "abc"}
    found, scans = rank_values(df, column_ranges(df, "abc"), ranks, max_rows=1)
    for i, c in enumerate("abc"):
        ordered = sorted(r[i] for r in rows)
        assert [found[c, r] for r in sorted(ranks[c])] == [ordered[r - 1] for r in sorted(ranks[c])]
    assert scans <= 4
    few = spark.createDataFrame([(i % 50,) for i in range(1000)], "q int")
    assert rank_values(few, column_ranges(few, ["q"]), {"q": {990}}, max_rows=1) == ({("q", 990): 49}, 1)
    assert exact_quantiles(few.where("q < 0"), ["q"], [0.5], ["m"]).count() == 0
