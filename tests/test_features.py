from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.functions.buckets import revenue_bucket
from tillroll.plans.features import add_features


def test_calendar_features(spark):
    # calendar: 2023-01-01 (Sunday, ISO week 52), 2024-02-29, 2024-12-30 (ISO week 1), NULL
    df = spark.createDataFrame(
        [(dt.date(2023, 1, 1),), (dt.date(2024, 2, 29),), (dt.date(2024, 12, 30),), (None,)],
        "date date",
    ).withColumn("total_amount_clean", F.lit(None).cast("decimal(18,2)"))
    rows = add_features(df, with_rank=False).collect()
    r0, r1, r2, r3 = rows
    assert (r0.year, r0.month, r0.day_of_week, r0.day_name, r0.week_of_year, r0.quarter, r0.is_weekend) == (
        2023, 1, 1, "Sunday", 52, 1, 1,
    )
    assert (r0.month_name, r0.year_month) == ("January", "2023-01")
    assert (r1.day_name, r1.is_weekend, r1.quarter, r1.year_month) == ("Thursday", 0, 1, "2024-02")
    assert (r2.week_of_year, r2.day_name, r2.quarter) == (1, "Monday", 4)
    assert r3.is_weekend == 0 and r3.year is None
    assert all(r.revenue_bucket == "Premium" for r in rows)  # NULL amount falls through


def test_revenue_bucket_edges(spark):
    vals = ["99.99", "100", "499.99", "500", "1999.99", "2000", None]
    df = spark.createDataFrame([(Decimal(v) if v else None,) for v in vals], "a decimal(18,2)")
    got = [r.b for r in df.select(revenue_bucket("a").alias("b")).collect()]
    assert got == ["Low", "Medium", "Medium", "High", "High", "Premium", "Premium"]


def test_features_with_rank(spark, sf_small):
    from pyspark.sql import Window

    from tillroll.plans.clean import clean
    from tillroll.plans.pipeline import raw_table

    c = clean(raw_table(spark, sf_small))
    f = add_features(c)
    assert f.count() == c.count()
    assert len(f.columns) == len(c.columns) + 11
    w = Window.partitionBy("customer_id").orderBy("date", "transaction_id")
    want = c.select("transaction_id", F.row_number().over(w).alias("r"))
    got = f.select("transaction_id", F.col("cust_txn_rank").alias("r"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
