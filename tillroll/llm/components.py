"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is one aggregate and one join on the node; edges are written to the shared folder
after every round. The number of rounds grows with the logarithm of the longest chain. A table
of up to ``FEW_EDGES`` edges, a bound that doesn't grow with the data, is worth no round of
shuffles: one task joins its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import ship
from tillroll.operators.joins import pinned

FEW_EDGES = 50_000

ship(__name__)


def _joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges from each node to the least of its component, by union-find."""
    above: dict = {}

    def top(x):
        while (y := above.setdefault(x, x)) != x:
            above[x] = x = above[y]
        return x

    for frame in frames:
        for a, b in frame.itertuples(index=False):
            a, b = top(a), top(b)
            if a != b:
                above[max(a, b)] = min(a, b)
    rows = [(x, y) for x in list(above) if (y := top(x)) != x]
    if rows:
        yield pd.DataFrame(rows, columns=["a", "b"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours.
    The least is aggregated before the join, so a node with many edges costs one row per
    task there, and the join's large side can be split."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    up = both.where("b > a")
    # the node itself keeps its link to the least
    # (repeats are left to the small star)
    return up.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.where("m < a").select("a", F.col("m").alias("b"))
    ).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point down here; a node's lower neighbours and itself link to the least."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select("a", F.col("m").alias("b"))
    ).where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (the least node) for every node that has an edge to another.

    Null ends and loops are ignored; repeated edges don't matter; no edges give no rows.
    """
    ends = edges.select(edges[a].alias("a"), edges[b].alias("b")).where("a <> b")
    now = pinned(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = lambda t: tuple(t.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    before = mark(now)
    if before[0] <= FEW_EDGES:
        now = pinned(now.coalesce(1).mapInPandas(_joined, now.schema))
    while before[0] > FEW_EDGES:
        now = pinned(_small_star(_large_star(now)))
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
