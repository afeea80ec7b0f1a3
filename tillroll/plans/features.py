"""Feature engineering: calendar columns and revenue bucket (one projection)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.buckets import revenue_bucket
from tillroll.functions.calendar import calendar_columns
from tillroll.operators.rank import customer_txn_rank
from tillroll.operators.rank import with_rank as join_rank
from tillroll.schema import CLEAN_COLUMNS


def add_features(
    cleaned: DataFrame, with_rank: bool = True, ranks: DataFrame | None = None, null_ids: bool = True
) -> DataFrame:
    """Adds year, month, day_of_week, day_name, week_of_year, quarter, is_weekend,
    month_name, year_month and revenue_bucket (one Project), and cust_txn_rank, the
    per-customer purchase rank (:mod:`tillroll.operators.rank`), joined by the id, which must
    be unique. ``ranks`` may be given where they come from rows narrower than ``cleaned``;
    ``with_rank=False`` leaves the rank and its shuffles out. Calendar columns that ``cleaned``
    has already (rows clustered by them) are kept, and with them the order of the rows.
    """
    cols = {name: c for name, c in calendar_columns("date").items() if name not in cleaned.columns}
    cols["revenue_bucket"] = revenue_bucket("total_amount_clean")
    out = cleaned.withColumns(cols)
    if not with_rank:
        return out
    return join_rank(out, customer_txn_rank(cleaned) if ranks is None else ranks, null_key=null_ids)


def export_frame(features: DataFrame) -> DataFrame:
    """The 21 exported columns; capped quantity and clean amount take the raw names."""
    return features.select(
        *[
            F.col("quantity_capped").alias("quantity")
            if c == "quantity"
            else F.col("total_amount_clean").cast("double").alias("total_amount")
            if c == "total_amount"
            else F.col(c)
            for c in CLEAN_COLUMNS
        ]
    )
