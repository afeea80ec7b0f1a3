"""Imputation: per-store modal city, fixed defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.joins import DEFAULT_BROADCAST_ROWS, broadcast_if_small

# Defaults for missing fields.
UNKNOWN_CITY = "Unknown"
GUEST_CUSTOMER = "GUEST"
UNKNOWN_PAYMENT = "Unknown"
NO_DISCOUNT = 0.0


def city_counts(df: DataFrame) -> DataFrame:
    """``(store_id, city, c)`` for non-null cities: a grouped count with map-side partial
    aggregation, so a store holding a third of all rows is not a hot reducer."""
    return (
        df.where(F.col("city").isNotNull())
        .groupBy("store_id", "city")
        .agg(F.count(F.lit(1)).alias("c"))
    )


def city_mode_from_counts(counts: DataFrame) -> DataFrame:
    """``(store_id, city_mode)``: the city with the highest count, smallest name on ties
    (a second aggregate over the small counts table)."""
    best = F.min(F.struct((-F.col("c")).alias("neg_c"), F.col("city").alias("city")))
    return (
        counts.where(F.col("city").isNotNull())
        .groupBy("store_id")
        .agg(best.alias("m"))
        .select("store_id", F.col("m.city").alias("city_mode"))
    )


def store_city_mode(df: DataFrame) -> DataFrame:
    """``(store_id, city_mode)``: most frequent non-null city per store, smallest on ties."""
    return city_mode_from_counts(city_counts(df))


def impute_city(
    df: DataFrame,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    modes: DataFrame | None = None,
    mode_rows: int | None = None,
) -> DataFrame:
    """Fill a NULL city with its store's modal city, else ``Unknown``.

    The mode table has one row per store; it is broadcast after a row-count check (no
    fan-out, no shuffle of the fact), and joined with a shuffle join beyond the limit. A
    NULL ``store_id`` never matches and falls to ``Unknown``. ``modes`` may be given when
    it was derived from an already pinned table (with its row count, if known).
    """
    if modes is None:
        modes = broadcast_if_small(store_city_mode(df), max_broadcast_rows)
    else:
        modes = broadcast_if_small(modes, max_broadcast_rows, pin=False, known_rows=mode_rows)
    return (
        df.join(modes, on="store_id", how="left")
        .withColumn("city", F.coalesce(F.col("city"), F.col("city_mode"), F.lit(UNKNOWN_CITY)))
        .drop("city_mode")
    )


def impute_defaults(df: DataFrame) -> DataFrame:
    """GUEST customer, Unknown payment, 0% discount for missing values."""
    return df.withColumns(
        {
            "customer_id": F.coalesce(F.col("customer_id"), F.lit(GUEST_CUSTOMER)),
            "payment_method": F.coalesce(F.col("payment_method"), F.lit(UNKNOWN_PAYMENT)),
            "discount_pct": F.coalesce(F.col("discount_pct"), F.lit(NO_DISCOUNT)),
        }
    )
