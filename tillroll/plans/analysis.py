"""Pipeline analyses and summary tables over the feature fact, each defined once.

A table is a grouping, optional distinct customers and a projection of the group's totals
(:class:`Table`). It can be computed alone, as a grouped aggregate that reads only the
columns it needs (``ANALYSES`` / ``SUMMARIES``), or with the others from two grouping-sets
passes (plans/report.py). Money uses exact decimal sums (functions/money.py). Top-k cuts
break ties on the grouping keys so the cut is deterministic.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.schema import MONEY

AMOUNT = "total_amount_clean"
QTY = "quantity_capped"


def totals() -> list[Column]:
    """Totals of a group: exact revenue, rows, rows with an amount, quantity."""
    return [
        F.sum(F.col(AMOUNT).cast(MONEY)).alias("_rev"),
        F.count(F.lit(1)).alias("_n"),
        F.count(AMOUNT).alias("_n_amt"),
        F.sum(QTY).cast("bigint").alias("_qty"),
    ]


def distinct_customers() -> Column:
    return F.count_distinct("customer_id").alias("_uc")


def _revenue() -> Column:
    return F.col("_rev").cast("double")


def _average() -> Column:
    return F.try_divide(F.col("_rev").cast("double"), F.col("_n_amt"))


@dataclass(frozen=True)
class Table:
    """``keys`` of the grouping, output columns as (name, column of the totals), order and
    number of rows. Output names are fixed values: the published column names."""

    keys: tuple[str, ...]
    columns: Callable[[], list[tuple[str, Column]]]
    order: Callable[[], list[Column | str]] | None = None
    limit: int | None = None
    customers: bool = False

    def finish(self, groups: DataFrame) -> DataFrame:
        out = groups.select(*self.keys, *[c.alias(n) for n, c in self.columns()])
        if self.order:
            out = out.orderBy(*self.order())
        return out.limit(self.limit) if self.limit else out

    def __call__(self, fact: DataFrame) -> DataFrame:
        extra = [distinct_customers()] if self.customers else []
        return self.finish(fact.groupBy(*self.keys).agg(*totals(), *extra))


N, QTY_SOLD, CUSTOMERS = (lambda: F.col("_n")), (lambda: F.col("_qty")), (lambda: F.col("_uc"))

ANALYSES: dict[str, Table] = {
    "revenue_by_category": Table(
        ("category",),
        lambda: [("total_revenue", _revenue()), ("num_transactions", N()), ("avg_order_value", _average())],
        lambda: [F.desc("total_revenue"), "category"],
    ),
    "top15_products": Table(
        ("product_name", "category"),
        lambda: [("revenue", _revenue())],
        lambda: [F.desc("revenue"), "product_name", "category"],
        limit=15,
    ),
    "monthly_revenue": Table(("year_month",), lambda: [("monthly_revenue", _revenue())], lambda: ["year_month"]),
    "city_performance": Table(
        ("city",),
        lambda: [("revenue", _revenue()), ("unique_customers", CUSTOMERS())],
        lambda: [F.desc("revenue"), "city"],
        customers=True,
    ),
    "payment_distribution": Table(
        ("payment_method",), lambda: [("txn_count", N())], lambda: [F.desc("txn_count"), "payment_method"]
    ),
    "weekend_vs_weekday": Table(
        ("is_weekend",), lambda: [("total_revenue", _revenue()), ("avg_order_value", _average()), ("num_orders", N())]
    ),
    "peak_hours": Table(("hour",), lambda: [("txn_count", N())], lambda: ["hour"]),
}

# summary tables (written next to the cleaned fact)
SUMMARIES: dict[str, Table] = {
    "summary_category": Table(
        ("category",),
        lambda: [
            ("total_revenue", _revenue()),
            ("num_transactions", N()),
            ("avg_order_value", _average()),
            ("total_quantity", QTY_SOLD()),
        ],
    ),
    "summary_monthly": Table(
        ("year_month",),
        lambda: [("monthly_revenue", _revenue()), ("monthly_orders", N()), ("unique_customers", CUSTOMERS())],
        lambda: ["year_month"],
        customers=True,
    ),
    "summary_city": Table(
        ("city",),
        lambda: [("revenue", _revenue()), ("orders", N()), ("unique_customers", CUSTOMERS())],
        customers=True,
    ),
    "summary_top_products": Table(
        ("product_name", "category"),
        lambda: [("revenue", _revenue()), ("qty_sold", QTY_SOLD())],
        lambda: [F.desc("revenue"), "product_name", "category"],
        limit=20,
    ),
    "summary_hourly": Table(("hour",), lambda: [("txn_count", N())], lambda: ["hour"]),
    "summary_payment": Table(("payment_method",), lambda: [("txn_count", N()), ("revenue", _revenue())]),
}

TABLES: dict[str, Table] = {**ANALYSES, **SUMMARIES}

revenue_by_category = ANALYSES["revenue_by_category"]
summary_category, summary_monthly = SUMMARIES["summary_category"], SUMMARIES["summary_monthly"]
summary_city, summary_payment = SUMMARIES["summary_city"], SUMMARIES["summary_payment"]
summary_hourly = SUMMARIES["summary_hourly"]
