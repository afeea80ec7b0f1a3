"""Profiling of the raw transactions: row count, NULLs, duplicate ids, numeric statistics.

Each profile is one aggregate pass (one job) returning a small frame; nothing is looped
column-by-column on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import parse_date
from tillroll.functions.quantiles import exact_quantiles
from tillroll.sources.files import REASONS, rejection

DESCRIBE_COLUMNS = ["quantity", "unit_price", "discount_pct", "total_amount"]
QUARTILE_COLUMNS = ["hour", "quantity", "unit_price", "discount_pct", "total_amount"]
# Display precision of the floating statistics (mean, stddev, interpolated quartiles).
STAT_DIGITS = 6


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("num_rows"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs in every column, named after the column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def duplicate_count(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """rows - distinct keys, where all NULL keys count as one key (as ``dropDuplicates``)."""
    k = F.col(key)
    distinct_keys = F.count_distinct(k) + F.when(F.count_if(k.isNull()) > 0, 1).otherwise(0)
    return df.agg(
        F.count(F.lit(1)).alias("num_rows"),
        distinct_keys.cast("bigint").alias("distinct_ids"),
    ).withColumn("duplicates", F.col("num_rows") - F.col("distinct_ids"))


def _stack_rows(one_row: DataFrame, columns: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """Turn a one-row frame with ``<stat>__<column>`` fields into one row per column."""
    args = [F.lit(len(columns))]
    for c in columns:
        args.append(F.lit(c))
        args.extend(F.col(f"{s}__{c}") for s in stats)
    return one_row.select(F.stack(*args).alias("column", *stats))


def describe_numeric(df: DataFrame, columns: Sequence[str] = DESCRIBE_COLUMNS) -> DataFrame:
    """Typed long form of ``describe()``: column, count, mean, stddev, min, max (doubles).

    All statistics of all columns come from a single aggregate; the one-row result is
    unpivoted (no expansion of the input rows).
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"count__{c}"),
            F.round(F.avg(x), STAT_DIGITS).alias(f"mean__{c}"),
            F.round(F.stddev_samp(x), STAT_DIGITS).alias(f"stddev__{c}"),
            F.min(x).alias(f"min__{c}"),
            F.max(x).alias(f"max__{c}"),
        ]
    return _stack_rows(df.agg(*aggs), columns, ["count", "mean", "stddev", "min", "max"])


def describe_quartiles(df: DataFrame, columns: Sequence[str] = QUARTILE_COLUMNS) -> DataFrame:
    """Long form of pandas ``describe()``: count, mean, std, min, 25%, 50%, 75%, max.

    Quartiles interpolate linearly between order statistics and are exact, computed by the
    distributed quantile operator (functions/quantiles.py).
    """
    basic = describe_numeric(df, columns).withColumnRenamed("stddev", "std")
    rows = basic.collect()  # one per column
    basic = df.sparkSession.createDataFrame(rows, basic.schema)
    ranges = {r["column"]: (r["count"], r["min"], r["max"]) for r in rows}
    quart = exact_quantiles(
        df, columns, [0.25, 0.5, 0.75], ["q25", "q50", "q75"], method="linear", ranges=ranges
    ).select("column", *[F.round(F.col(q), STAT_DIGITS).alias(q) for q in ["q25", "q50", "q75"]])
    # both sides have one row per column: a join of two tiny tables
    return basic.join(quart, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


DISTINCT_FIELDS = {"categories": "category", "products": "product_name", "cities": "city", "customers": "customer_id"}


def distinct_counts(df: DataFrame, fields: dict[str, str] = DISTINCT_FIELDS) -> DataFrame:
    """One row: exact number of distinct non-null values per column, from one scan.

    The columns are stacked as (field, value) pairs, made distinct with map-side partial
    aggregation (a hot value costs one row per task) and counted per field.
    """
    stacked = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("f"), F.col(c).cast("string").alias("v")) for n, c in fields.items()])
        ).alias("s")
    ).select("s.f", "s.v")
    per_field = stacked.where(F.col("v").isNotNull()).distinct().groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    return per_field.agg(
        *[F.coalesce(F.max(F.when(F.col("f") == n, F.col("n"))), F.lit(0)).alias(n) for n in fields]
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    """Rows, columns, date range, distinct categories/products/cities/customers, NULLs.

    Two aggregates: a plain global one (rows, date range, NULLs) and the stacked distinct
    counts, attached as one scalar subquery (a struct), so no grouped stage has to carry the
    string min/max (which would force sort-based aggregation over expanded rows).
    """
    total_nulls = None
    for c in df.columns:
        n = F.count_if(F.col(c).isNull())
        total_nulls = n if total_nulls is None else total_nulls + n
    distinct = distinct_counts(df)
    sub = distinct.select(F.struct(*distinct.columns).alias("d")).scalar()
    return (
        df.agg(
            F.count(F.lit(1)).alias("num_rows"),
            F.lit(len(df.columns)).alias("num_columns"),
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
            total_nulls.alias("null_values"),
        )
        .withColumn("_d", sub)  # one subquery; its fields are read in the next projection
        .select(
            "num_rows", "num_columns", "min_date", "max_date",
            *[F.col(f"_d.{n}").alias(n) for n in DISTINCT_FIELDS],
            "null_values",
        )
    )


def profile_pass(df: DataFrame, numeric: Sequence[str] = DESCRIBE_COLUMNS) -> DataFrame:
    """Row count, NULLs per column, dates that don't parse, rows to be set aside by reason and
    describe statistics of ``numeric`` in one aggregate
    (one job, no shuffle beyond the single-partition merge of partial aggregates)."""
    aggs = [F.count(F.lit(1)).alias("num_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls__{c}") for c in df.columns]
    aggs.append(F.count_if(F.col("date").isNotNull() & parse_date("date").isNull()).alias("rejected_dates"))
    aggs += [F.count_if(rejection(df) == r).alias(f"quarantined__{r}") for r in REASONS]
    for c in numeric:
        x = F.col(c).cast("double")
        aggs += [
            F.avg(x).alias(f"mean__{c}"),
            F.stddev_samp(x).alias(f"stddev__{c}"),
            F.min(x).alias(f"min__{c}"),
            F.max(x).alias(f"max__{c}"),
        ]
    return df.agg(*aggs)


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """The reference's profiling step as lazy frames: NULLs per column, duplicate ids and
    describe statistics of the four numeric columns."""
    return {
        "null_counts": null_counts(df),
        "duplicate_count": duplicate_count(df),
        "describe_numeric": describe_numeric(df),
    }
