"""Size-checked broadcast for a small side whose size is only known at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import scratch_path, scratch_table

# Rows up to which a derived lookup table is broadcast; beyond it the join stays a
# shuffle join (sort-merge, with AQE splitting skewed partitions).
DEFAULT_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(
    small: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, pin: bool = True, known_rows: int | None = None
) -> DataFrame:
    """Pin ``small`` and broadcast it only if it has at most ``max_rows`` rows.

    The check is a count over the pinned table (written to the shared checkpoint folder, so
    lineage is cut and executor loss does not recompute it), reading at most
    ``max_rows + 1`` rows. ``pin=False`` skips pinning when ``small`` is already derived
    from a pinned table; ``known_rows`` is its row count when the caller has it already.
    """
    if pin:
        small = pinned(small)
    n = known_rows if known_rows is not None else small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def pinned(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once as a written table in the shared checkpoint folder and read it
    back: one job, lineage cut (a lost executor does not recompute it), columnar, and with
    file statistics the planner can use. Values computed from non-deterministic expressions
    (e.g. a partition id) are fixed from then on."""
    path = scratch_path(df.sparkSession, "pinned")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """As :func:`pinned`, but stored by the hash of ``key``, in as many buckets as there are
    shuffle partitions: reading it back, a join or grouping by ``key`` needs no exchange of
    these rows. ``df`` should come from an exchange by ``key``, then a bucket is one file."""
    spark = df.sparkSession
    path = scratch_path(spark, "bucketed")
    name = scratch_table(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    return spark.table(name)
