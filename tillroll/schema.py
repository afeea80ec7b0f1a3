"""Declared schemas: raw transactions, cleaned export, feature fact and summary files."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Money is carried as decimal(18,2) inside the plans and exposed as double at the edges.
MONEY = DecimalType(18, 2)

# Names and types of the input and output columns below.

# Raw transaction file: 13 columns, read with this schema and never inferred.
RAW_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType(), False),
        StructField("date", StringType(), True),
        StructField("hour", IntegerType(), True),
        StructField("customer_id", StringType(), True),
        StructField("store_id", StringType(), True),
        StructField("city", StringType(), True),
        StructField("product_name", StringType(), True),
        StructField("category", StringType(), True),
        StructField("quantity", IntegerType(), True),
        StructField("unit_price", DoubleType(), True),
        StructField("discount_pct", DoubleType(), True),
        StructField("total_amount", DoubleType(), True),
        StructField("payment_method", StringType(), True),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# Cleaned, exported fact: 21 columns (capped quantity and recomputed amount take the
# raw names back).
CLEAN_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType(), True),
        StructField("date", DateType(), True),
        StructField("hour", IntegerType(), True),
        StructField("customer_id", StringType(), True),
        StructField("store_id", StringType(), True),
        StructField("city", StringType(), True),
        StructField("product_name", StringType(), True),
        StructField("category", StringType(), True),
        StructField("quantity", IntegerType(), True),
        StructField("unit_price", DoubleType(), True),
        StructField("discount_pct", DoubleType(), True),
        StructField("total_amount", DoubleType(), True),
        StructField("payment_method", StringType(), True),
        StructField("year", IntegerType(), True),
        StructField("month", IntegerType(), True),
        StructField("day_of_week", IntegerType(), True),
        StructField("day_name", StringType(), True),
        StructField("quarter", IntegerType(), True),
        StructField("is_weekend", IntegerType(), True),
        StructField("year_month", StringType(), True),
        StructField("revenue_bucket", StringType(), True),
    ]
)
CLEAN_COLUMNS = [f.name for f in CLEAN_SCHEMA.fields]

# Columns of the cleaned frame before features (15): raw 13 with a parsed date, plus the
# capped quantity and the recomputed amount.
CLEANED_COLUMNS = [
    "transaction_id", "date", "hour", "customer_id", "store_id", "city", "product_name",
    "category", "quantity", "unit_price", "discount_pct", "total_amount", "payment_method",
    "quantity_capped", "total_amount_clean",
]

# Feature fact written by the pipeline: cleaned columns plus the calendar features, the
# revenue bucket and the per-customer purchase rank.
FACT_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType(), True),
        StructField("date", DateType(), True),
        StructField("hour", IntegerType(), True),
        StructField("customer_id", StringType(), True),
        StructField("store_id", StringType(), True),
        StructField("city", StringType(), True),
        StructField("product_name", StringType(), True),
        StructField("category", StringType(), True),
        StructField("quantity", IntegerType(), True),
        StructField("unit_price", DoubleType(), True),
        StructField("discount_pct", DoubleType(), True),
        StructField("total_amount", DoubleType(), True),
        StructField("payment_method", StringType(), True),
        StructField("quantity_capped", IntegerType(), True),
        StructField("total_amount_clean", MONEY, True),
        StructField("month", IntegerType(), True),
        StructField("day_of_week", IntegerType(), True),
        StructField("day_name", StringType(), True),
        StructField("week_of_year", IntegerType(), True),
        StructField("quarter", IntegerType(), True),
        StructField("is_weekend", IntegerType(), True),
        StructField("month_name", StringType(), True),
        StructField("year_month", StringType(), True),
        StructField("revenue_bucket", StringType(), True),
        StructField("cust_txn_rank", IntegerType(), True),
        # partition column of the written fact; Spark appends it last on read
        StructField("year", IntegerType(), True),
    ]
)

# Published summary files (header names and types).
SUMMARY_SCHEMAS = {
    "summary_category": StructType(
        [
            StructField("category", StringType(), True),
            StructField("total_revenue", DoubleType(), True),
            StructField("num_transactions", LongType(), True),
            StructField("avg_order_value", DoubleType(), True),
            StructField("total_quantity", LongType(), True),
        ]
    ),
    "summary_monthly": StructType(
        [
            StructField("year_month", StringType(), True),
            StructField("monthly_revenue", DoubleType(), True),
            StructField("monthly_orders", LongType(), True),
            StructField("unique_customers", LongType(), True),
        ]
    ),
    "summary_city": StructType(
        [
            StructField("city", StringType(), True),
            StructField("revenue", DoubleType(), True),
            StructField("orders", LongType(), True),
            StructField("unique_customers", LongType(), True),
        ]
    ),
    "summary_top_products": StructType(
        [
            StructField("product_name", StringType(), True),
            StructField("category", StringType(), True),
            StructField("revenue", DoubleType(), True),
            StructField("qty_sold", LongType(), True),
        ]
    ),
    "summary_hourly": StructType(
        [
            StructField("hour", IntegerType(), True),
            StructField("txn_count", LongType(), True),
        ]
    ),
    "summary_payment": StructType(
        [
            StructField("payment_method", StringType(), True),
            StructField("txn_count", LongType(), True),
            StructField("revenue", DoubleType(), True),
        ]
    ),
}
