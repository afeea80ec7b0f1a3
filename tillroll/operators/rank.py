"""Per-customer purchase rank (``row_number`` by date, then transaction id) without a hot task.

A plain ``Window.partitionBy("customer_id")`` sends every row of one customer to one task;
a guest/anonymous id can hold a large share of all rows. So customers are told apart by a
summary of frequent items, and only three columns move:

1. ``approx_top_k`` sketches of a few hundred partitions each are combined to one; it names the
   customers that may have more than ``hot_rows`` rows, at most ``MAX_HOT`` (a sketch that
   tracks ``TRACKED`` items misses none that has a larger share than some 4 / ``TRACKED``);
2. all other customers are ranked by the plain window, one hash exchange;
3. rows of the frequent ones are range-partitioned by (customer, date, id) -- a total order,
   so one customer's rows are split over as many ordered partitions as their volume needs --
   and pinned with the partition id. ``row_number`` runs per (partition, customer), and a
   customer continued from earlier partitions gets the number of its rows there as an offset:
   one pair per partition boundary at most, so that table is broadcast.

Which customers take which way changes no rank. Output: ``transaction_id, customer_id, date,
cust_txn_rank``; :func:`with_rank` joins the rank to whole rows by their id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.joins import pinned

# Rows of one customer that a window task sorts without trouble.
HOT_ROWS = 1_000_000
MAX_HOT, TRACKED, LEAVES = 2_000, 20_000, 256


def _frequent(df: DataFrame, customer: str, hot_rows: int) -> list:
    """The customers with an estimate of over ``hot_rows`` rows, a null one among them; at most
    ``MAX_HOT``. Sketches of partitions are combined in two steps, so that the last one reads
    ``LEAVES`` of them."""
    sketch = F.call_function("approx_top_k_accumulate", F.col(customer), F.lit(TRACKED))
    leaves = df.select(customer, F.pmod(F.spark_partition_id(), F.lit(LEAVES)).alias("_leaf")).groupBy("_leaf").agg(sketch.alias("s"))
    whole = F.call_function("approx_top_k_combine", F.col("s"), F.lit(TRACKED))
    whole = F.call_function("approx_top_k_estimate", whole, F.lit(MAX_HOT))
    # grouped by a constant: no rows give no sketch to combine
    found = leaves.groupBy(F.lit(0).alias("all")).agg(whole.alias("top")).first()
    return [x["item"] for x in (found["top"] if found else []) if x["count"] > hot_rows]


def _hot_table(df: DataFrame, customer: str, values: list) -> DataFrame:
    return df.sparkSession.createDataFrame([(v,) for v in values], f"_hot {df.schema[customer].dataType.simpleString()}")


def frequent_customers(df: DataFrame, customer: str = "customer_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """One column ``_hot``: the customers that :func:`_frequent` names."""
    return _hot_table(df, customer, _frequent(df, customer, hot_rows))


def _ranged(rows: DataFrame, customer: str, order: tuple[str, ...], out: str, partitions: int | None) -> DataFrame:
    """Ranks by ordered partitions and offsets."""
    keys = [customer, *order]
    # without an explicit count AQE sizes the range partitions; coalescing only merges
    # adjacent ranges, so partition ids stay in key order
    by = [F.col(k).asc_nulls_first() for k in keys]
    spread = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    ranged = pinned(spread.withColumn("_pid", F.spark_partition_id()))
    local = ranged.withColumn(
        "_local",
        F.row_number().over(
            Window.partitionBy("_pid", customer).orderBy(*[F.col(k).asc_nulls_first() for k in order])
        ),
    )
    sizes = ranged.groupBy("_pid", customer).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(customer).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sizes.withColumn("_off", F.sum("_n").over(earlier))
        .where(F.col("_off") > 0)
        .select(F.col("_pid").alias("_opid"), F.col(customer).alias("_ocust"), "_off")
    )
    joined = local.join(
        F.broadcast(offsets),
        (local["_pid"] == offsets["_opid"]) & local[customer].eqNullSafe(offsets["_ocust"]),
        "left",
    )
    return joined.select(*keys, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_local")).cast("int").alias(out))


def customer_txn_rank(
    df: DataFrame,
    customer: str = "customer_id",
    order: tuple[str, ...] = ("date", "transaction_id"),
    out: str = "cust_txn_rank",
    partitions: int | None = None,
    unranked: tuple[str, ...] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``unranked`` customer ids (e.g. an anonymous ``GUEST``) get a NULL rank and skip the
    ranking work altogether. ``partitions`` is the number of ranges that frequent customers
    are split over, by default as adaptive execution sizes them."""
    keys = [customer, *order]
    rows = df.select(*keys)
    if unranked:
        skip = F.col(customer).isin(*unranked)
        left_out = rows.where(skip).select(*keys, F.lit(None).cast("int").alias(out))
        ranked = customer_txn_rank(rows.where(~skip | F.col(customer).isNull()), customer, order, out, partitions, (), hot_rows)
        return ranked.unionByName(left_out)
    # ids begin alike, so a sort by their text compares whole texts; by their hash first, derived
    # behind the exchange, it compares numbers
    window = Window.partitionBy("_at", customer).orderBy(*[F.col(k).asc_nulls_first() for k in order])
    plain = lambda some: (
        some.repartition(customer)
        .withColumn("_at", F.xxhash64(customer))
        .withColumn(out, F.row_number().over(window).cast("int"))
        .drop("_at")
    )
    frequent = _frequent(rows, customer, hot_rows)
    if not frequent:
        return plain(rows)
    hot = _hot_table(rows, customer, frequent)
    is_hot = rows[customer].eqNullSafe(hot["_hot"])
    hot = F.broadcast(hot)  # MAX_HOT rows at most
    some = _ranged(rows.join(hot, is_hot, "left_semi"), customer, order, out, partitions)
    return plain(rows.join(hot, is_hot, "left_anti")).unionByName(some)


def with_rank(rows: DataFrame, ranks: DataFrame, key: str = "transaction_id", rank: str = "cust_txn_rank", null_key: bool = True) -> DataFrame:
    """``rows`` with the rank of their id joined to them. Ids are unique; of rows that are stored
    by id (``joins.bucketed``) none moves. The ranks of a partition are hashed, so the wide rows
    are not sorted for the join; its partitions should be of bounded size
    (``session.spread_for``). ``null_key=False``: no id is NULL, which saves looking for the one
    that may be."""
    of = ranks.select(F.col(key).alias("_ranked"), rank).hint("shuffle_hash")
    out = rows.join(of, rows[key] == F.col("_ranked"), "left").drop("_ranked")
    if null_key:
        lost = ranks.where(F.col(key).isNull()).agg(F.max(rank)).scalar()
        out = out.withColumn(rank, F.when(F.col(key).isNull(), lost).otherwise(F.col(rank)))
    return out
