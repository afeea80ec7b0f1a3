"""Dashboard filter state -> one lazy filtered view of the cleaned fact.

``FilterSpec`` holds an optional inclusive date range and three optional value lists
(``None`` = no filter on that field, an empty tuple = no rows, like an empty multiselect).
Over the Parquet fact written by the pipeline the whole predicate reaches the scan as
``PushedFilters``, and the date range also yields a ``year`` predicate that prunes the
year partitions.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FilterSpec:
    date_from: dt.date | None = None
    date_to: dt.date | None = None
    categories: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    payments: tuple[str, ...] | None = None

    @staticmethod
    def from_range(date_range, **lists) -> FilterSpec:
        """Dashboard rule: a complete pair is the range; one picked date (or none) means
        no date restriction, i.e. the data's own bounds."""
        if date_range is not None and len(date_range) == 2:
            lo, hi = date_range
            return FilterSpec(lo, hi, **lists)
        return FilterSpec(None, None, **lists)


# Fixed filter used by the registered dashboard queries.
DEFAULT_SPEC = FilterSpec(
    date_from=dt.date(1996, 1, 1),
    date_to=dt.date(1999, 12, 31),
    categories=("ECONOMY", "PROMO", "SMALL"),
    cities=tuple(f"NATION_{i}" for i in range(6)),
    payments=("1-URGENT", "2-HIGH", "3-MEDIUM"),
)


def _member(col: str, values: tuple[str, ...]) -> Column:
    return F.col(col).isin(*values) if values else F.lit(False)


def predicate(spec: FilterSpec, year_column: bool = False) -> Column:
    # without a range the data's own bounds hold, which a row without a date is not within
    preds: list[Column] = [F.col("date").isNotNull()] if spec.date_from is None and spec.date_to is None else []
    if spec.date_from is not None:
        preds.append(F.col("date") >= F.lit(spec.date_from))
        if year_column:
            preds.append(F.col("year") >= spec.date_from.year)
    if spec.date_to is not None:
        preds.append(F.col("date") <= F.lit(spec.date_to))
        if year_column:
            preds.append(F.col("year") <= spec.date_to.year)
    for col, values in (
        ("category", spec.categories),
        ("city", spec.cities),
        ("payment_method", spec.payments),
    ):
        if values is not None:
            preds.append(_member(col, values))
    out = F.lit(True)
    for p in preds:
        out = out & p
    return out


def view(df: DataFrame, spec: FilterSpec = DEFAULT_SPEC) -> DataFrame:
    return df.where(predicate(spec, year_column="year" in df.columns))


def date_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def coverage(df: DataFrame, spec: FilterSpec = DEFAULT_SPEC) -> DataFrame:
    """"Showing X of Y": both counts in one pass."""
    return df.agg(
        F.count_if(F.coalesce(predicate(spec), F.lit(False))).alias("shown"),
        F.count(F.lit(1)).alias("total"),
    )


def filter_options(df: DataFrame) -> DataFrame:
    """Sorted distinct values of the three filter fields, long form ``(field, value)``,
    from a single scan (unpivot, then one distinct with map-side combine)."""
    return (
        df.select(
            F.stack(
                F.lit(3),
                F.lit("category"), F.col("category"),
                F.lit("city"), F.col("city"),
                F.lit("payment_method"), F.col("payment_method"),
            ).alias("field", "value")
        )
        .distinct()
        .orderBy("field", "value")
    )
