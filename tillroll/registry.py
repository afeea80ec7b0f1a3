"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Three kinds of inputs, all derived by Spark from the star tables in ``sf_dir``:

* ``raw``  -- the 13-column raw transactions (sources/star.py), for profiling and for each
  cleaning step run as its own lazy operator;
* ``fact`` -- the feature fact written once per application (plans/pipeline.py) and read
  back from Parquet, for the analyses and summaries;
* ``view`` -- the 21-column export of the fact filtered by the dashboard ``FilterSpec``.

The CSV/Parquet round-trip keys write to a fresh path under the shared checkpoint folder
and return the frame read back with the declared schema.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import profile
from tillroll.operators.cap import cap_column, outliers, quantile_cap
from tillroll.operators.dedup import dedup_transactions
from tillroll.operators.impute import impute_city, impute_defaults, store_city_mode
from tillroll.operators.joins import pinned
from tillroll.operators.rank import customer_txn_rank
from tillroll.plans.analysis import ANALYSES, SUMMARIES, summary_category
from tillroll.plans.clean import null_total, with_parsed_date
from tillroll.operators.distinct import bitmaps, count_members
from tillroll.plans.dashboard import DASH_QUERIES
from tillroll.plans.features import export_frame
from tillroll.plans.pipeline import fact_path, fact_table, published_summaries, raw_path, raw_table, rollup_path, run_pipeline
from tillroll.plans.rollup import panels, read_rollups, stacked
from tillroll.plans.view import DEFAULT_SPEC, FilterSpec, coverage, date_bounds, filter_options, view
from tillroll.schema import CLEANED_COLUMNS, FACT_SCHEMA, RAW_SCHEMA, SUMMARY_SCHEMAS
from tillroll.session import scratch_path
from tillroll.sources import files

Query = Callable[[SparkSession, str], DataFrame]

# Published column names.
FEATURE_COLUMNS = [
    "transaction_id", "year", "month", "day_of_week", "day_name", "week_of_year",
    "quarter", "is_weekend", "month_name", "year_month",
]

# Single-field filters (the full dashboard filter is DEFAULT_SPEC).
SINGLE_FILTERS = {
    "filter_date_range": FilterSpec(date_from=DEFAULT_SPEC.date_from, date_to=DEFAULT_SPEC.date_to),
    "filter_category": FilterSpec(categories=DEFAULT_SPEC.categories),
    "filter_city": FilterSpec(cities=DEFAULT_SPEC.cities),
    "filter_payment": FilterSpec(payments=DEFAULT_SPEC.payments),
}


# One date picked of two: no restriction but the data's own bounds.
ONE_DATE = FilterSpec.from_range((dt.date(1997, 1, 1),))
# Filter states that some views have rows under, and some not.
FILTER_STATES = {
    "default": DEFAULT_SPEC,
    "one_date": ONE_DATE,
    "no_category": FilterSpec(categories=()),
    "before_all_data": FilterSpec(date_to=dt.date(1900, 1, 1)),
}
# Summaries that are written in the query about missing files.
PARTLY = ("summary_category", "summary_payment")


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return raw_table(spark, sf)


def _dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_transactions(_raw(spark, sf))


def _dedup_written(spark: SparkSession, sf: str) -> DataFrame:
    """The deduplicated rows written once, for queries that read them twice."""
    return pinned(_dedup(spark, sf))


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return fact_table(spark, sf)


def _export(spark: SparkSession, sf: str) -> DataFrame:
    return export_frame(_fact(spark, sf))


def _view(spark: SparkSession, sf: str, spec: FilterSpec = DEFAULT_SPEC) -> DataFrame:
    return view(_export(spark, sf), spec)


def _money_double(df: DataFrame) -> DataFrame:
    return df.withColumn("total_amount_clean", F.col("total_amount_clean").cast("double"))


# --- sources and sinks ------------------------------------------------------------------


def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = files.write_csv(_raw(spark, sf), scratch_path(spark, "raw_csv"))
    return files.read_raw_csv(spark, path)


def csv_scan_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """The raw file with its columns turned round and one more among them."""
    raw = _raw(spark, sf)
    turned = raw.select(*reversed(raw.columns)).withColumn("note", F.lit("x")).select("note", *reversed(raw.columns))
    return files.read_raw_csv(spark, files.write_csv(turned, scratch_path(spark, "turned_csv")))


def summary_availability(spark: SparkSession, sf: str) -> DataFrame:
    """Which of the processed files there are after only two summaries were written: name,
    available, rows."""
    at = scratch_path(spark, "partly")
    for name in PARTLY:
        files.write_csv(SUMMARIES[name](_fact(spark, sf)), f"{at}/{name}.csv")
    found = {name: files.read_summary(spark, f"{at}/{name}.csv", name) for name in SUMMARIES}
    rows = [(name, t is not None, None if t is None else t.count()) for name, t in found.items()]
    try:
        files.read_cleaned_csv(spark, f"{at}/cleaned.csv")
    except files.MissingInputError:
        rows.append(("cleaned", False, None))
    return spark.createDataFrame(rows, "name string, available boolean, num_rows long")


def cleaned_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = files.write_csv(_export(spark, sf), scratch_path(spark, "cleaned_csv"))
    return files.read_cleaned_csv(spark, path)


def summary_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = files.write_csv(summary_category(_fact(spark, sf)), scratch_path(spark, "summary_category"))
    return files.read_summary(spark, path, "summary_category")


def export_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    path = files.write_parquet(_export(spark, sf), scratch_path(spark, "cleaned_parquet"), partition_by="year")
    return files.read_cleaned_parquet(spark, path)


# --- cleaning steps, each as its own lazy operator over the raw rows -------------------


def parse_date_q(spark: SparkSession, sf: str) -> DataFrame:
    return with_parsed_date(_dedup(spark, sf)).select("transaction_id", "date")


def store_city_mode_q(spark: SparkSession, sf: str) -> DataFrame:
    return store_city_mode(with_parsed_date(_dedup(spark, sf)))


def impute_city_mode_q(spark: SparkSession, sf: str) -> DataFrame:
    return impute_city(with_parsed_date(_dedup_written(spark, sf))).select("transaction_id", "store_id", "city")


def quantity_p99(spark: SparkSession, sf: str) -> DataFrame:
    return quantile_cap(_dedup_written(spark, sf), "quantity").select(F.col("cap").cast("int").alias("p99"))


def outlier_count(spark: SparkSession, sf: str) -> DataFrame:
    return outliers(_dedup_written(spark, sf), "quantity").agg(F.count(F.lit(1)).alias("outliers"))


def outlier_rows(spark: SparkSession, sf: str) -> DataFrame:
    return outliers(_dedup_written(spark, sf), "quantity")


def cap_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return cap_column(_dedup_written(spark, sf), "quantity", "quantity_capped").select(
        "transaction_id", "quantity", "quantity_capped"
    )


def recompute_amount(spark: SparkSession, sf: str) -> DataFrame:
    return _money_double(
        _fact(spark, sf).select(
            "transaction_id", "unit_price", "quantity_capped", "discount_pct", "total_amount_clean"
        )
    )


def clean_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _money_double(_fact(spark, sf).select(*CLEANED_COLUMNS))


def remaining_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return null_total(_fact(spark, sf).select(*CLEANED_COLUMNS))


# --- features ---------------------------------------------------------------------------


def feature_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf).select(*FEATURE_COLUMNS)


def revenue_bucket_q(spark: SparkSession, sf: str) -> DataFrame:
    return _money_double(_fact(spark, sf).select("transaction_id", "total_amount_clean", "revenue_bucket"))


def customer_txn_rank_q(spark: SparkSession, sf: str) -> DataFrame:
    return customer_txn_rank(_fact(spark, sf))


def features_with_rank(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf).select("transaction_id", "customer_id", "date", "revenue_bucket", "cust_txn_rank")


def pipeline_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Runs the whole job over the raw rows and reads its six summary files back."""
    result = run_pipeline(spark, _raw(spark, sf), scratch_path(spark, "pipeline"))
    return published_summaries(spark, result["paths"])


def row_count_q(spark: SparkSession, sf: str) -> DataFrame:
    """From the footers of the raw files."""
    return profile.row_count(files.read_footers(spark, raw_path(spark, sf), RAW_SCHEMA))


def filter_date_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """From the footers of the fact."""
    return date_bounds(files.read_footers(spark, fact_path(spark, sf), FACT_SCHEMA))


def _on_raw(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: fn(_raw(spark, sf))


def _on_fact(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: fn(_fact(spark, sf))


def _on_view(fn: Callable[[DataFrame], DataFrame], spec: FilterSpec = DEFAULT_SPEC) -> Query:
    return lambda spark, sf: fn(_view(spark, sf, spec))


def _on_export(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: fn(_export(spark, sf))


def filter_states(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the view of each filter state has no row: state, is_empty."""
    rows = [(name, _view(spark, sf, spec).isEmpty()) for name, spec in FILTER_STATES.items()]
    return spark.createDataFrame(rows, "state string, is_empty boolean")


def dash_panels(spark: SparkSession, sf: str) -> DataFrame:
    """All panels and the KPIs under the default filter, from the written rollups."""
    tables = read_rollups(spark, rollup_path(spark, sf))
    return stacked(panels(tables, DEFAULT_SPEC, _export(spark, sf)))


def customers_by_level(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct customers per month and city, per month, per city and in all: the bitmaps of
    the first merged into those of the others."""
    grain = ("year", "month", "city")
    sets = pinned(bitmaps(fact_table(spark, sf), "customer_id", grain))
    levels = {"month_city": grain, "month": grain[:2], "city": grain[2:], "all": ()}
    one = lambda name, keys: count_members(sets, keys, "unique_customers").select(
        F.lit(name).alias("level"),
        *[(F.col(c) if c in keys else F.lit(None).cast(FACT_SCHEMA[c].dataType)).alias(c) for c in grain],
        "unique_customers",
    )
    return reduce(DataFrame.union, [one(name, keys) for name, keys in levels.items()])


QUERIES: dict[str, Query] = {
    # sources / sinks
    "csv_scan": csv_scan,
    "csv_scan_by_name": csv_scan_by_name,
    "cleaned_scan": cleaned_scan,
    "summary_scan": summary_scan,
    "summary_availability": summary_availability,
    "export_cleaned": export_cleaned,
    "project_cleaned": _on_export(lambda e: e),
    # profile
    "row_count": row_count_q,
    "null_counts": _on_raw(profile.null_counts),
    "duplicate_count": _on_raw(profile.duplicate_count),
    "describe_numeric": _on_raw(profile.describe_numeric),
    "describe_quartiles": _on_raw(profile.describe_quartiles),
    "dataset_summary": _on_raw(profile.dataset_summary),
    # cleaning
    "dedup_transactions": _dedup,
    "parse_date": parse_date_q,
    "store_city_mode": store_city_mode_q,
    "impute_city_mode": impute_city_mode_q,
    "impute_defaults": lambda spark, sf: impute_defaults(_dedup(spark, sf)),
    "quantity_p99": quantity_p99,
    "outlier_count": outlier_count,
    "outlier_rows": outlier_rows,
    "cap_outliers": cap_outliers,
    "recompute_amount": recompute_amount,
    "clean_transactions": clean_transactions,
    "remaining_nulls": remaining_nulls,
    # features
    "feature_columns": feature_columns,
    "revenue_bucket": revenue_bucket_q,
    "customer_txn_rank": customer_txn_rank_q,
    "features_with_rank": features_with_rank,
    "pipeline_summaries": pipeline_summaries,
    # analyses and summaries
    **{name: _on_fact(fn) for name, fn in ANALYSES.items()},
    **{name: _on_fact(fn) for name, fn in SUMMARIES.items()},
    # dashboard view
    **{name: _on_view(lambda v: v, spec) for name, spec in SINGLE_FILTERS.items()},
    "filtered_view": _on_view(lambda v: v),
    "filter_one_date": _on_view(lambda v: v, ONE_DATE),
    "filter_states": filter_states,
    "filter_date_bounds": filter_date_bounds,
    "filter_coverage": _on_export(coverage),
    "filter_options": _on_export(filter_options),
    **{name: _on_view(fn) for name, fn in DASH_QUERIES.items()},
    "dash_panels": dash_panels,
    "customers_by_level": customers_by_level,
}

assert set(SUMMARY_SCHEMAS) <= set(QUERIES)
