"""Rollups of the fact that answer the dashboard's panels under any filter.

Two tables of totals at the grain of the filter fields: ``sales`` by date, category, city,
payment method, hour and discount, ``products`` by date, category, city, payment method and
product. Their number of rows is bounded by the values of these fields and not by the number
of transactions, and a filter state (:class:`tillroll.plans.view.FilterSpec`) applies to them
as it does to the fact, because all its fields are in the grain. The product has a table of
its own: in one grain with hour and discount there would be nearly a row per transaction.

Totals are exact (decimal amounts, counts) and add up, so a panel over a rollup equals the panel
over the rows. Distinct customers don't add up; :func:`unique_customers` counts them from the
filtered rows, of which it reads the customer and the filter fields only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, LongType, StructField, StructType

from tillroll.functions.money import money
from tillroll.operators.joins import pinned
from tillroll.plans import dashboard as D
from tillroll.plans.view import DEFAULT_SPEC, FilterSpec, predicate, view
from tillroll.schema import CLEAN_SCHEMA, MONEY
from tillroll.session import together
from tillroll.sources.files import write_parquet

FILTERED = ("date", "category", "city", "payment_method")
# calendar columns that the date determines; they are in the grouping to be kept
CALENDAR = ("year", "quarter", "month", "year_month", "day_name", "is_weekend")
GRAINS: dict[str, tuple[str, ...]] = {
    "sales": (*FILTERED, *CALENDAR, "hour", "discount_pct"),
    "products": (*FILTERED, "year", "month", "product_name"),
}
LAYOUT = {"partition_by": "year", "cluster_by": ("month",), "sort_by": ("date", "city")}

# Aggregates of a group's totals.
TOTALS = D.Measures(
    revenue=lambda: F.sum("_rev").cast("double"),
    rows=lambda: F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint"),
    orders=lambda: F.coalesce(F.sum("_n_amt"), F.lit(0)).cast("bigint"),
    average=lambda: F.try_divide(F.sum("_rev").cast("double"), F.sum("_n_amt")),
    quantity=lambda: F.sum("_qty").cast("bigint"),
    discount=lambda: F.try_divide(F.sum("_disc"), F.sum("_n_disc")),
)


def _row_totals() -> list[Column]:
    return [
        F.sum(money(D.AMOUNT)).alias("_rev"),
        F.count(F.lit(1)).alias("_n"),
        F.count(D.AMOUNT).alias("_n_amt"),
        F.sum("quantity").cast("bigint").alias("_qty"),
        F.sum("discount_pct").alias("_disc"),
        F.count("discount_pct").alias("_n_disc"),
    ]


# a sum of MONEY has ten more digits
_TYPES = {
    "_rev": DecimalType(MONEY.precision + 10, MONEY.scale), "_n": LongType(), "_n_amt": LongType(),
    "_qty": LongType(), "_disc": DoubleType(), "_n_disc": LongType(),
}


def _added_totals() -> list[Column]:
    return [F.sum(c).alias(c) for c in _TYPES]


def rollups(cleaned: DataFrame) -> dict[str, DataFrame]:
    """Both rollups of the exported cleaned rows; each pre-aggregates in its map tasks."""
    return {name: cleaned.groupBy(*grain).agg(*_row_totals()) for name, grain in GRAINS.items()}


def write_rollups(cleaned: DataFrame, path: str) -> dict[str, DataFrame]:
    """Writes both rollups under ``path``, laid out as the fact is, and reads them back."""
    made = rollups(cleaned)
    together(cleaned.sparkSession, *[lambda n=n, t=t: write_parquet(t, f"{path}/{n}", **LAYOUT) for n, t in made.items()])
    return read_rollups(cleaned.sparkSession, path)


def schema(name: str) -> StructType:
    """Columns of a written rollup: its grain as in the export, then the totals."""
    keys = [StructField(c, CLEAN_SCHEMA[c].dataType) for c in GRAINS[name]]
    totals = [StructField(c, t) for c, t in _TYPES.items()]
    return StructType(keys + totals)


def read_rollups(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(schema(name)).parquet(f"{path}/{name}") for name in GRAINS}


# Panels by the grouping that they read, next to the function that finishes them.
PANELS: dict[str, tuple[tuple[str, ...], object]] = {
    "dash_monthly_trend": (("year_month",), D.monthly_trend),
    "dash_category_revenue": (("category",), D.category_revenue),
    "dash_category_share": (("category",), D.category_share),
    "dash_city_revenue": (("city",), D.city_revenue),
    "dash_payment_share": (("payment_method",), D.payment_share),
    "dash_heatmap_wide": (("day_name", "hour"), D.heatmap_wide),
    "dash_heatmap_long": (("day_name", "hour"), D.heatmap_long),
    "dash_quarterly": (("year", "quarter"), D.quarterly),
    "dash_discount_impact": (("discount_pct",), D.discount_impact),
    "dash_weekend": (("is_weekend",), D.weekend),
}


def panel_groups(sales: DataFrame) -> tuple[DataFrame, dict[tuple[str, ...], int]]:
    """Totals of every grouping that the panels read, from one pass over the filtered rollup,
    and each grouping's id in ``_gid`` (bit i from the right is 1 when the i-th key from the
    right is aggregated away)."""
    sets = list(dict.fromkeys(keys for keys, _ in PANELS.values()))
    keys = list(dict.fromkeys(k for s in sets for k in s))
    ids = {s: sum(1 << i for i, k in enumerate(reversed(keys)) if k not in s) for s in sets}
    return sales.groupingSets([list(s) for s in sets], *keys).agg(*_added_totals(), F.grouping_id().alias("_gid")), ids


def unique_customers(cleaned: DataFrame, spec: FilterSpec = DEFAULT_SPEC) -> DataFrame:
    return view(cleaned, spec).agg(F.count_distinct("customer_id").alias("unique_customers"))


def panels(tables: dict[str, DataFrame], spec: FilterSpec = DEFAULT_SPEC, cleaned: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every panel under one filter state, by name, from one scan of each rollup: the sales'
    groups are written once (a few thousand rows) and each panel finishes its own. The KPIs
    are without ``unique_customers`` unless the rows, ``cleaned``, are given."""
    groups, ids = panel_groups(view(tables["sales"], spec))
    groups = pinned(groups)
    out = {name: panel(groups.where(F.col("_gid") == ids[keys]), TOTALS) for name, (keys, panel) in PANELS.items()}
    out["dash_top10_products"] = D.top10_products(view(tables["products"], spec), TOTALS)
    columns = D.kpi_columns(TOTALS)
    if cleaned is not None:
        columns["unique_customers"] = unique_customers(cleaned, spec).scalar()
    whole = groups.where(F.col("_gid") == ids[PANELS["dash_discount_impact"][0]])
    out["kpis"] = whole.agg(*[columns[n].alias(n) for n in D.KPI_COLUMNS if n in columns])
    return out


def coverage(tables: dict[str, DataFrame], spec: FilterSpec = DEFAULT_SPEC) -> DataFrame:
    """"Showing X of Y" from the rollup."""
    shown = F.when(F.coalesce(predicate(spec), F.lit(False)), F.col("_n")).otherwise(0)
    counted = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint") for c in (shown, F.col("_n"))]
    return tables["sales"].agg(counted[0].alias("shown"), counted[1].alias("total"))


def stacked(found: dict[str, DataFrame]) -> DataFrame:
    """Panels stacked to ``panel``, ``key`` (its grouping values), ``measure``, ``value``."""

    def long(name: str, table: DataFrame) -> DataFrame:
        keys = KEYS[name]
        measures = [c for c, t in table.dtypes if c not in keys and t != "string"]
        pairs = [x for c in measures for x in (F.lit(c), F.col(c).cast("double"))]
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]) if keys else F.lit("")
        return table.select(F.lit(name).alias("panel"), key.alias("key"), F.stack(F.lit(len(measures)), *pairs).alias("measure", "value"))

    return reduce(DataFrame.union, [long(n, t) for n, t in found.items()])


KEYS: dict[str, tuple[str, ...]] = {
    **{name: keys for name, (keys, _) in PANELS.items()},
    "dash_payment_share": ("method",),
    "dash_heatmap_wide": ("day_name",),
    "dash_top10_products": ("product_name",),
    "kpis": (),
}
