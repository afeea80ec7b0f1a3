"""Adapter: the star-schema test tables -> 13-column raw transactions.

The test data is an order/line-item star schema with no nulls and no outliers. This adapter
derives one raw transaction row per line item with the same columns as the raw retail file,
and injects deterministic nulls, quantity outliers, a store with no known city and duplicate
transaction ids (line items sharing an order key and line number), so that every cleaning
rule has work to do.

Join plan. ``orders`` is joined to ``customer`` and ``nation`` first (order-sized), then
``lineitem`` to that on the order key and to ``part`` on the part key. Line items to orders
is a fact-to-fact join -- both sides grow with the data -- so it is pinned to a sort-merge
join on the order key (``merge`` hint): neither side is ever broadcast, the work is spread
over shuffle partitions even when a file is a single row group, and AQE splits skewed
partitions at run time. The dimension joins are left to Catalyst, which broadcasts a side
only when its size estimate is under ``autoBroadcastJoinThreshold`` (the 25-row nation
table always; customer/part only at small scale) and otherwise plans a sort-merge join.
Only the columns needed are read, so the Parquet scans carry a pruned ``ReadSchema``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schema import RAW_COLUMNS

TABLES = ("lineitem", "orders", "customer", "nation", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pad_id(c: Column, width: int) -> Column:
    """Zero-pad a non-negative integer key to ``width`` digits; longer keys stay whole.

    (Plain ``lpad`` truncates longer strings, which would merge distinct keys at scale.)
    """
    s = c.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13-column raw transactions derived from the star schema (string ``date``)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_discount",
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")

    order_side = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "n_name")
    )
    j = li.join(order_side.hint("merge"), li.l_orderkey == order_side.o_orderkey).join(
        part, li.l_partkey == part.p_partkey
    )

    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    store_no = sk % 50
    return j.select(
        F.concat(F.lit("TXN-"), pad_id(ok, 7), F.lit("-"), F.col("l_linenumber").cast("string")).alias(
            "transaction_id"
        ),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        (F.lit(7) + (ok * 3 + F.col("l_linenumber")) % 16).cast("int").alias("hour"),
        F.when((ok * 7 + pk) % 67 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("CUST-"), pad_id(F.col("o_custkey"), 5)))
        .alias("customer_id"),
        F.concat(F.lit("STORE-"), pad_id(store_no, 3)).alias("store_id"),
        F.when((store_no == 7) | ((ok * 11 + pk) % 100 == 0), F.lit(None).cast("string"))
        .otherwise(F.col("n_name"))
        .alias("city"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        (
            F.col("l_quantity").cast("int")
            + F.when((ok * 13 + pk) % 200 == 0, F.lit(150)).otherwise(F.lit(0))
        ).alias("quantity"),
        (F.col("p_retailprice") / 10).alias("unit_price"),
        F.when((ok * 17 + pk) % 200 == 1, F.lit(None).cast("double"))
        .otherwise(F.round(F.col("l_discount") * 100).cast("int").cast("double"))
        .alias("discount_pct"),
        F.col("l_extendedprice").alias("total_amount"),
        F.when((ok * 19 + pk) % 125 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_orderpriority"))
        .alias("payment_method"),
    ).select(*RAW_COLUMNS)
