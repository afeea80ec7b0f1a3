"""Unit tests of the cleaning rules on hand-written fixtures (FIXTURES.md section 5)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import raw_rows
from tillroll.functions.money import line_amount
from tillroll.schema import CLEANED_COLUMNS
from tillroll.operators.cap import cap_column, outliers, quantile_cap
from tillroll.operators.dedup import dedup_transactions
from tillroll.operators.impute import impute_city, impute_defaults, store_city_mode
from tillroll.plans.clean import clean, null_total, with_parsed_date


def test_dedup_keeps_smallest_row_and_groups_null_ids(spark):
    # dup_ids: same id with different rows; two NULL ids
    df = raw_rows(
        spark,
        [
            ("T1", "2024-01-02", 9, "C2"),
            ("T1", "2024-01-01", 10, "C1"),
            ("T1", "2024-01-01", 10, None),
            ("T2", "2024-01-05", 7, "C3"),
            (None, "2024-01-03", 8, "C4"),
            (None, "2024-01-03", 8, "C5"),
        ],
    )
    out = {r.transaction_id: r for r in dedup_transactions(df).collect()}
    assert len(out) == 3
    # NULLs sort first within the remaining columns
    assert (out["T1"].date, out["T1"].hour, out["T1"].customer_id) == ("2024-01-01", 10, None)
    assert out[None].customer_id == "C4"
    assert out["T2"].hour == 7


def test_dedup_is_idempotent(spark, sf_small):
    from tillroll.plans.pipeline import raw_table

    once = dedup_transactions(raw_table(spark, sf_small))
    twice = dedup_transactions(once)
    assert once.count() == twice.count() == once.select("transaction_id").distinct().count()
    assert once.exceptAll(twice).count() == 0


def test_parse_date_rejects_become_null(spark):
    df = raw_rows(spark, [("T1", "2024-02-29"), ("T2", "2024-02-30"), ("T3", "garbage"), ("T4", None)])
    got = {r.transaction_id: r.date for r in with_parsed_date(df).collect()}
    assert got == {"T1": dt.date(2024, 2, 29), "T2": None, "T3": None, "T4": None}


def test_city_mode_ties_missing_and_null_store(spark):
    # mode_ties: tie -> smallest city; store with no known city -> Unknown; NULL store -> Unknown
    rows = [
        ("a1", "2024-01-01", 8, "C", "S1", "Pune"),
        ("a2", "2024-01-01", 8, "C", "S1", "Delhi"),
        ("a3", "2024-01-01", 8, "C", "S1", None),
        ("b1", "2024-01-01", 8, "C", "S2", None),
        ("c1", "2024-01-01", 8, "C", None, None),
        ("d1", "2024-01-01", 8, "C", "S3", "Agra"),
        ("d2", "2024-01-01", 8, "C", "S3", "Agra"),
        ("d3", "2024-01-01", 8, "C", "S3", "Bhopal"),
        ("d4", "2024-01-01", 8, "C", "S3", None),
    ]
    df = raw_rows(spark, rows)
    modes = {r.store_id: r.city_mode for r in store_city_mode(df).collect()}
    assert modes == {"S1": "Delhi", "S3": "Agra"}
    filled = {r.transaction_id: r.city for r in impute_city(df).collect()}
    assert filled["a1"] == "Pune" and filled["a3"] == "Delhi"
    assert filled["b1"] == "Unknown" and filled["c1"] == "Unknown"
    assert filled["d4"] == "Agra"


def test_city_mode_join_falls_back_to_shuffle_join_beyond_limit(spark):
    df = raw_rows(spark, [(f"t{i}", "2024-01-01", 8, "C", f"S{i % 5}", None if i % 3 == 0 else f"X{i % 2}") for i in range(40)])
    small = impute_city(df, max_broadcast_rows=1000)
    big = impute_city(df, max_broadcast_rows=2)
    assert sorted(small.collect(), key=str) == sorted(big.collect(), key=str)
    small.collect()
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_defaults(spark):
    df = raw_rows(spark, [("T1", "2024-01-01", 8, None, "S1", "X", "p", "c", 1, 2.0, None, 2.0, None)])
    r = impute_defaults(df).first()
    assert (r.customer_id, r.payment_method, r.discount_pct) == ("GUEST", "Unknown", 0.0)


def test_exact_p99_cap(spark):
    # cap_tail: 200 rows 1..199 plus one at 500 -> exact discrete p99 is the 199th value
    rows = [(f"T{i}", "2024-01-01", 8, "C", "S", "X", "p", "c", i) for i in range(1, 200)]
    rows.append(("T500", "2024-01-01", 8, "C", "S", "X", "p", "c", 500))
    rows.append(("TNULL", "2024-01-01", 8, "C", "S", "X", "p", "c", None))
    df = raw_rows(spark, rows)
    assert quantile_cap(df, "quantity").first().cap == 198  # ceil(0.99 * 200) = 198th value
    capped = {r.transaction_id: r.quantity_capped for r in cap_column(df).collect()}
    assert capped["T500"] == 198 and capped["T199"] == 198 and capped["T5"] == 5
    assert capped["TNULL"] is None
    assert {r.transaction_id for r in outliers(df).collect()} == {"T199", "T500"}


def test_amount_is_exact_half_up(spark):
    # amount_edges: exact half cents round up; NULL price -> NULL; missing discount -> 0 %
    df = spark.createDataFrame(
        [(1.005, 1, 0.0), (0.125, 1, 0.0), (10.0, 3, 15.0), (19.99, 7, 5.0), (None, 1, 0.0), (2.5, 2, None)],
        "p double, q int, d double",
    )
    out = [r.a for r in df.select(line_amount("p", "q", F.coalesce("d", F.lit(0.0))).alias("a")).collect()]
    assert out == [Decimal("1.01"), Decimal("0.13"), Decimal("25.50"), Decimal("132.93"), None, Decimal("5.00")]


def test_clean_end_to_end_columns_and_no_nulls_in_filled(spark, sf_small):
    from tillroll.plans.pipeline import raw_table

    c = clean(raw_table(spark, sf_small))
    assert sorted(c.columns) == sorted(CLEANED_COLUMNS)
    nulls = c.agg(*[F.count_if(F.col(x).isNull()).alias(x) for x in ["city", "customer_id", "payment_method", "discount_pct"]]).first()
    assert all(v == 0 for v in nulls)
    assert null_total(c).first().remaining_nulls == 0


def test_amount_keeps_fractions(spark):
    # fractional percent, price below the cent, quantities of seven and ten digits
    df = spark.createDataFrame(
        [(10.0, 1, 12.5), (90.101, 50, 0.0), (1.0, 1_000_001, 0.0), (0.01, 2_147_483_647, 50.0), (0.333333, 3, 0.0001)],
        "p double, q int, d double",
    )
    out = [r.a for r in df.select(line_amount("p", "q", "d").alias("a")).collect()]
    assert out == [Decimal(x) for x in ("8.75", "4505.05", "1000001.00", "10737418.24", "1.00")]


def test_approximate_cap_option(spark):
    rows = [(f"T{i}", "2024-01-01", 8, "C", "S", "X", "p", "c", i) for i in range(1, 1001)]
    df = raw_rows(spark, rows)
    exact = quantile_cap(df, "quantity").first().cap
    approx = quantile_cap(df, "quantity", accuracy=10_000).first().cap
    assert exact == 990 and abs(approx - exact) <= 1


def test_rejected_dates_count(spark):
    from tillroll.operators.profile import profile_pass

    df = raw_rows(spark, [("T1", "2024-02-29"), ("T2", "2024-02-30"), ("T3", "garbage"), ("T4", None)])
    assert profile_pass(df).first().rejected_dates == 2
