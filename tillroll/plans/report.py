"""All analyses and summaries of plans/analysis.py from two aggregate passes over the fact.

Tables without distinct customers share one ``GROUPING SETS`` pass over their groupings;
those with them share another, because the distinct count needs its own (group, customer)
level, which Spark pre-aggregates per map task. The passes have one row per output group;
they are written once and the tables are the projections that their definitions give.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.joins import pinned
from tillroll.plans.analysis import TABLES, distinct_customers, totals
from tillroll.session import together


def _pass(fact: DataFrame, customers: bool) -> tuple[DataFrame, dict[tuple[str, ...], int]]:
    """Totals of every grouping that the tables of one kind use, and each one's grouping id
    (bit i from the right is 1 when the i-th key from the right is aggregated away)."""
    sets = list(dict.fromkeys(t.keys for t in TABLES.values() if t.customers == customers))
    keys = list(dict.fromkeys(k for s in sets for k in s))
    ids = {s: sum(1 << i for i, k in enumerate(reversed(keys)) if k not in s) for s in sets}
    extra = [distinct_customers()] if customers else []
    got = fact.groupingSets([list(s) for s in sets], *keys).agg(*totals(), *extra, F.grouping_id().alias("_gid"))
    return got, ids


def report_tables(fact: DataFrame, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> dict[str, DataFrame]:
    """All tables by name. ``keep`` writes a pass (given its name) and reads it back; by
    default they are scratch tables."""
    keep = keep or (lambda df, name: pinned(df))
    kinds = ((False, "totals"), (True, "customer_totals"))
    passes = [_pass(fact, customers) for customers, _ in kinds]
    kept = together(fact.sparkSession, *[lambda got=got, name=name: keep(got, name) for (got, _), (_, name) in zip(passes, kinds)])
    out = {}
    for (customers, _), (_, ids), got in zip(kinds, passes, kept):
        for table, t in TABLES.items():
            if t.customers == customers:
                out[table] = t.finish(got.where(F.col("_gid") == ids[t.keys]))
    return {name: out[name] for name in TABLES}
