"""Winsorise a column at an exact quantile, inside the lazy plan.

The cap is a one-row aggregate used as a scalar subquery (``DataFrame.scalar()``): Catalyst
runs it once and inlines the value, with no cross join and no Python float on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.quantiles import percentile_disc

CAP_QUANTILE = 0.99


def quantile_cap(
    df: DataFrame,
    column: str = "quantity",
    p: float = CAP_QUANTILE,
    accuracy: int | None = None,
    ranges: dict[str, tuple] | None = None,
) -> DataFrame:
    """One-row frame with the ``p`` quantile of ``column`` (same type).

    Exact discrete quantile by default. With ``accuracy`` set, Spark's
    ``percentile_approx`` is used instead (a bounded-size sketch per task, merged; relative
    rank error about 1/accuracy) -- the cheaper option where an exact cut is not required.
    """
    if accuracy is None:
        return percentile_disc(df, column, p, name="cap", ranges=ranges)
    dtype = df.schema[column].dataType
    return df.agg(F.percentile_approx(column, p, accuracy).cast(dtype).alias("cap"))


def capped(value: Column, cap: Column) -> Column:
    """``value`` if not above ``cap``; NULL stays NULL; a NULL cap caps nothing."""
    return F.when(value > cap, cap).otherwise(value)


def cap_column(
    df: DataFrame,
    column: str = "quantity",
    out: str = "quantity_capped",
    p: float = CAP_QUANTILE,
    cap: DataFrame | None = None,
) -> DataFrame:
    cap_df = quantile_cap(df, column, p) if cap is None else cap
    value = cap_df.scalar()
    return df.withColumn(out, capped(F.col(column), value).cast(df.schema[column].dataType))


def outliers(df: DataFrame, column: str = "quantity", p: float = CAP_QUANTILE, cap: DataFrame | None = None) -> DataFrame:
    """Rows strictly above the cap."""
    cap_df = quantile_cap(df, column, p) if cap is None else cap
    return df.where(F.col(column) > cap_df.scalar())
