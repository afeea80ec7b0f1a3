"""Revenue bucket of a line amount."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (exclusive) and labels; anything else -- including a NULL
# amount -- is the last label.
REVENUE_BUCKETS = [(100, "Low"), (500, "Medium"), (2000, "High")]
TOP_BUCKET = "Premium"


def revenue_bucket(amount: Column | str) -> Column:
    amount = F.col(amount) if isinstance(amount, str) else amount
    out = None
    for bound, label in REVENUE_BUCKETS:
        out = (F.when if out is None else out.when)(amount < bound, F.lit(label))
    return out.otherwise(F.lit(TOP_BUCKET))
