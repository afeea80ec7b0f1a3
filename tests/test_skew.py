"""Hot keys: a third of all rows on one store, one customer and one id (a group of copies)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators.dedup import dedup_transactions
from tillroll.operators.rank import customer_txn_rank
from tillroll.plans.clean import clean
from tillroll.plans.pipeline import raw_table


def _hot(spark, sf_small):
    raw = raw_table(spark, sf_small)
    hot = F.abs(F.hash("transaction_id")) % 3 == 0
    return (
        raw.withColumn("store_id", F.when(hot, F.lit("STORE-HOT")).otherwise(F.col("store_id")))
        .withColumn("customer_id", F.when(hot, F.lit(None)).otherwise(F.col("customer_id")))
        # a group of copies: another third shares one id, with different contents
        .withColumn(
            "transaction_id",
            F.when(F.abs(F.hash("transaction_id")) % 3 == 1, F.lit("TXN-COPY")).otherwise(F.col("transaction_id")),
        )
    )


def test_dedup_and_clean_under_hot_keys(spark, sf_small):
    raw = _hot(spark, sf_small)
    rest = [c for c in raw.columns if c != "transaction_id"]
    w = Window.partitionBy("transaction_id").orderBy(*[F.col(c).asc_nulls_first() for c in rest])
    want = raw.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    got = dedup_transactions(raw)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    c = clean(raw)
    assert c.count() == got.count()
    assert c.where(F.col("city").isNull() | F.col("customer_id").isNull()).count() == 0
    # the hot store's missing cities were filled with its modal city
    hot_mode = (
        got.where((F.col("store_id") == "STORE-HOT") & F.col("city").isNotNull())
        .groupBy("city").count().orderBy(F.desc("count"), "city").first()["city"]
    )
    filled = c.join(got.where(F.col("city").isNull()).select("transaction_id"), "transaction_id")
    assert filled.where(F.col("store_id") == "STORE-HOT").select("city").distinct().collect()[0][0] == hot_mode


def test_rank_under_a_hot_guest(spark, sf_small):
    c = clean(_hot(spark, sf_small))
    got = customer_txn_rank(c, partitions=8)
    w = Window.partitionBy("customer_id").orderBy("date", "transaction_id")
    want = c.select("transaction_id", "customer_id", "date", F.row_number().over(w).alias("cust_txn_rank"))
    want = want.select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    split = customer_txn_rank(c, partitions=8, hot_rows=500)  # the guest by range
    assert got.exceptAll(split).count() == 0 and split.exceptAll(got).count() == 0
    assert got.where(F.col("customer_id") == "GUEST").agg(F.max("cust_txn_rank")).first()[0] > 1000


def test_pipeline_under_hot_keys(spark, sf_small, tmp_out):
    from tillroll.plans.pipeline import read_fact, run_pipeline

    raw = _hot(spark, sf_small)
    res = run_pipeline(spark, raw, tmp_out)
    fact = read_fact(spark, res["paths"]["fact"])
    n = dedup_transactions(raw).count()
    assert res["profile"]["rows_after_dedup"] == n == fact.count()
    cat = res["tables"]["revenue_by_category"].agg(F.sum("num_transactions")).first()[0]
    assert cat == n
    assert fact.where(F.col("customer_id") == "GUEST").count() > n // 4
