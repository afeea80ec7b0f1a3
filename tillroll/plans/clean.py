"""Cleaning composite: dedup -> parse date -> impute city/defaults -> cap -> amount."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import parse_date
from tillroll.functions.money import line_amount
from tillroll.operators.cap import cap_column, quantile_cap
from tillroll.operators.dedup import dedup_transactions
from tillroll.operators.impute import GUEST_CUSTOMER, city_mode_from_counts, impute_city, impute_defaults
from tillroll.operators.joins import DEFAULT_BROADCAST_ROWS, pinned


def with_parsed_date(df: DataFrame) -> DataFrame:
    return df.withColumn("date", parse_date("date"))


def with_amount(df: DataFrame) -> DataFrame:
    """``total_amount_clean``: recomputed from price, capped quantity and discount."""
    return df.withColumn(
        "total_amount_clean", line_amount("unit_price", "quantity_capped", "discount_pct")
    )


def imputed_with_cap(
    deduped: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The cleaning rules that fill values (13 columns), the cap of the quantity that
    :func:`priced` takes, and the numbers of rows, of rows without an id and of stores.

    ``deduped`` should be a written table: the (store, city) counts, the quantity quantile and
    the rows each read it, the first two only their columns."""
    # a few rows per store, partially aggregated per map task
    counts = deduped.groupBy("store_id", "city")
    counts = pinned(counts.agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col("transaction_id").isNull()).alias("no_id"),
                               F.count("quantity").alias("n"), F.min("quantity").alias("lo"), F.max("quantity").alias("hi")))
    sizes = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("no_id"), F.lit(0)).alias("null_ids"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.count_distinct(F.when(F.col("city").isNotNull(), F.col("store_id"))).alias("stores"),
    ).first().asDict()
    quantities = {"quantity": (sizes["n"], sizes["lo"], sizes["hi"])}
    df = with_parsed_date(deduped)
    df = impute_city(df, max_broadcast_rows, modes=city_mode_from_counts(counts), mode_rows=sizes["stores"])
    return impute_defaults(df), quantile_cap(deduped, "quantity", ranges=quantities), sizes


def priced(imputed: DataFrame, cap: DataFrame) -> DataFrame:
    """Adds the two columns that follow from a row and the cap: quantity and amount."""
    return with_amount(cap_column(imputed, "quantity", "quantity_capped", cap=cap))


def clean_deduped_with_sizes(
    deduped: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
) -> tuple[DataFrame, dict[str, int]]:
    """The cleaning rules after dedup (15 columns), and the numbers of :func:`imputed_with_cap`."""
    df, cap, sizes = imputed_with_cap(deduped, max_broadcast_rows)
    return priced(df, cap), sizes


def purchases(deduped: DataFrame) -> DataFrame:
    """Id, customer and date of the cleaned rows, from these three columns alone."""
    rows = deduped.select("transaction_id", "customer_id", "date")
    return with_parsed_date(rows).withColumn("customer_id", F.coalesce("customer_id", F.lit(GUEST_CUSTOMER)))


def clean_deduped(deduped: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The cleaning rules after dedup (15 columns)."""
    return clean_deduped_with_sizes(deduped, max_broadcast_rows)[0]


def clean(raw: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Raw 13 columns -> cleaned 15 columns. The deduplicated rows are written once and read
    for both lookups (the store -> city table and the quantity histogram, small written
    tables themselves) and for the rows."""
    return clean_deduped(pinned(dedup_transactions(raw)), max_broadcast_rows)


def null_total(df: DataFrame) -> DataFrame:
    """Total number of NULL cells over all columns, in one pass (one row)."""
    total = None
    for c in df.columns:
        n = F.count_if(F.col(c).isNull())
        total = n if total is None else total + n
    return df.agg(total.alias("remaining_nulls"))
