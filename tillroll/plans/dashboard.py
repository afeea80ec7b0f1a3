"""Dashboard data: KPIs and the chart tables, each a lazy aggregate over the filtered view.

Input is the exported 21-column fact (``quantity`` = capped, ``total_amount`` = recomputed).
"Orders" here counts non-null amounts, as the dashboard does; shares divide by the grouped
table's total, computed as a scalar subquery.

A panel is written over :class:`Measures`: the same definition aggregates rows of the fact or
rows of a rollup (plans/rollup.py) that already hold totals.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.calendar import DAY_ORDER, day_index, quarter_label, weekend_label
from tillroll.functions.money import money_avg, money_sum

AMOUNT = "total_amount"
# Published column names.
KPI_COLUMNS = ("total_revenue", "total_orders", "avg_order_value", "unique_customers", "total_quantity", "avg_discount")
HOURS = list(range(24))  # heatmap columns: every hour of the day, so no sale falls out


@dataclass(frozen=True)
class Measures:
    """Aggregates of a group's rows: revenue, rows, rows with an amount, average amount,
    quantity and average discount."""

    revenue: Callable[[], Column]
    rows: Callable[[], Column]
    orders: Callable[[], Column]
    average: Callable[[], Column]
    quantity: Callable[[], Column]
    discount: Callable[[], Column]


ROWS = Measures(
    revenue=lambda: money_sum(AMOUNT),
    rows=lambda: F.count(F.lit(1)),
    orders=lambda: F.count(AMOUNT),
    average=lambda: money_avg(AMOUNT),
    quantity=lambda: F.sum("quantity").cast("bigint"),
    discount=lambda: F.avg("discount_pct"),
)


def kpi_columns(m: Measures) -> dict[str, Column]:
    """The KPIs but for the distinct customers."""
    return {
        "total_revenue": m.revenue(),
        "total_orders": m.rows(),
        "avg_order_value": m.average(),
        "total_quantity": m.quantity(),
        "avg_discount": m.discount(),
    }


def kpis(v: DataFrame) -> DataFrame:
    columns = {**kpi_columns(ROWS), "unique_customers": F.count_distinct("customer_id")}
    return v.agg(*[columns[n].alias(n) for n in KPI_COLUMNS])


def monthly_trend(v: DataFrame, m: Measures = ROWS) -> DataFrame:
    return (
        v.groupBy("year_month")
        .agg(m.revenue().alias("revenue"), m.orders().alias("orders"))
        .orderBy("year_month")
    )


def category_revenue(v: DataFrame, m: Measures = ROWS) -> DataFrame:
    return v.groupBy("category").agg(m.revenue().alias("revenue")).orderBy("revenue", "category")


def _with_share(counts: DataFrame) -> DataFrame:
    """share = count / total count, the total as a scalar subquery (a distributed global
    sum), so no single-partition window has to hold the grouped table."""
    total = counts.agg(F.sum("count").cast("double")).scalar()
    return counts.withColumn("share", F.col("count").cast("double") / total)


def category_share(v: DataFrame, m: Measures = ROWS) -> DataFrame:
    counts = v.where(F.col("category").isNotNull()).groupBy("category").agg(m.rows().alias("count"))
    return _with_share(counts).orderBy(F.desc("count"), "category")


def top10_products(v: DataFrame, m: Measures = ROWS, k: int = 10) -> DataFrame:
    top = (
        v.groupBy("product_name")
        .agg(m.revenue().alias("revenue"))
        .orderBy(F.desc("revenue"), "product_name")
        .limit(k)
    )
    return top.orderBy("revenue", F.desc("product_name"))


def city_revenue(v: DataFrame, m: Measures = ROWS) -> DataFrame:
    return (
        v.groupBy("city")
        .agg(m.revenue().alias("revenue"), m.orders().alias("orders"))
        .orderBy(F.desc("revenue"), "city")
    )


def payment_share(v: DataFrame, m: Measures = ROWS) -> DataFrame:
    counts = (
        v.where(F.col("payment_method").isNotNull())
        .groupBy(F.col("payment_method").alias("method"))
        .agg(m.rows().alias("count"))
    )
    return _with_share(counts).orderBy(F.desc("count"), "method")


def heatmap_long(v: DataFrame, m: Measures = ROWS) -> DataFrame:
    return v.groupBy("day_name", "hour").agg(m.revenue().alias("revenue"))


def heatmap_wide(v: DataFrame, m: Measures = ROWS) -> DataFrame:
    """7 rows (Monday..Sunday) x revenue per hour 0..23, zero where there were no sales.

    One aggregation (pivot with the hour values given, so no extra job to find them),
    then a left join from the fixed 7-row weekday list to the at most 8 pivoted rows.
    """
    spark: SparkSession = v.sparkSession
    pivot = (
        v.groupBy("day_name")
        .pivot("hour", HOURS)
        .agg(m.revenue())
        .select("day_name", *[F.col(str(h)).alias(f"hour_{h}") for h in HOURS])
    )
    days = spark.createDataFrame([(d,) for d in DAY_ORDER], "day_name string")
    hour_cols = [f"hour_{h}" for h in HOURS]
    return (
        days.join(pivot, "day_name", "left")
        .na.fill(0.0, subset=hour_cols)
        .orderBy(day_index("day_name"))
        .select("day_name", *hour_cols)
    )


def quarterly(v: DataFrame, m: Measures = ROWS) -> DataFrame:
    return (
        v.groupBy("year", "quarter")
        .agg(m.revenue().alias("revenue"))
        .withColumn("period", quarter_label("year", "quarter"))
        .orderBy("year", "quarter")
    )


def discount_impact(v: DataFrame, m: Measures = ROWS) -> DataFrame:
    return (
        v.groupBy("discount_pct")
        .agg(m.revenue().alias("revenue"), m.orders().alias("orders"))
        .orderBy("discount_pct")
    )


def weekend(v: DataFrame, m: Measures = ROWS) -> DataFrame:
    return (
        v.groupBy("is_weekend")
        .agg(
            m.revenue().alias("revenue"),
            m.orders().alias("orders"),
            m.average().alias("avg_val"),
        )
        .withColumn("type", weekend_label("is_weekend"))
        .orderBy("is_weekend")
    )


def preview(v: DataFrame, n: int = 500) -> DataFrame:
    """First ``n`` rows of the view in transaction-id order (a top-k, not a full sort)."""
    return v.orderBy("transaction_id").limit(n)


DASH_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "kpis": kpis,
    "dash_monthly_trend": monthly_trend,
    "dash_category_revenue": category_revenue,
    "dash_category_share": category_share,
    "dash_top10_products": top10_products,
    "dash_city_revenue": city_revenue,
    "dash_payment_share": payment_share,
    "dash_heatmap_wide": heatmap_wide,
    "dash_heatmap_long": heatmap_long,
    "dash_quarterly": quarterly,
    "dash_discount_impact": discount_impact,
    "dash_weekend": weekend,
    "preview_rows": preview,
}


def dashboard(cleaned: DataFrame, spec=None, rollups: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Every dashboard table for one filter state, over the exported cleaned fact (as read
    by ``sources.files.read_cleaned_csv`` / ``read_cleaned_parquet``). With its ``rollups``
    (plans/rollup.py) all but the preview, the distinct customers and the date bounds come
    from them."""
    from tillroll.plans import rollup
    from tillroll.plans.view import DEFAULT_SPEC, coverage, date_bounds, filter_options, view

    spec = DEFAULT_SPEC if spec is None else spec
    v = view(cleaned, spec)
    out = {name: fn(v) for name, fn in DASH_QUERIES.items()}
    if rollups:
        out.update(rollup.panels(rollups, spec, cleaned))
    out.update(
        {
            "filter_date_bounds": date_bounds(cleaned),
            "filter_options": filter_options(rollups["sales"] if rollups else cleaned),
            "filter_coverage": rollup.coverage(rollups, spec) if rollups else coverage(cleaned, spec),
        }
    )
    return out
