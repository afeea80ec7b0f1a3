"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target number of words; a document of a source is to be taken
target / source size times on average, which is a whole part plus a probability. Pivotal
rounding makes the probabilities whole: of two documents one hands word mass to the other
at random, keeping the sum of words, until one of the two probabilities is 0 or 1. Groups
of documents do that side by side and leave at most one open document each; the open
documents are grouped again, level by level, until at most FAN_IN are left per source. This
root group is drawn from the largest to the smallest document, each draw carrying its
rounding error to the next, so a source ends within about its smallest open document of its
target. Built-in functions only.

The draws come from hashes of the document and the level, so reruns agree.

Defined results: a null text has size 0, as has a text without words; a document of size 0
takes no words. A null source is a source of its own and stands last. Repeated rows are
rounded one by one. An empty table gives no rows. A source without words has target 0.
Extra columns are kept by :func:`mix_copies` and not used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import broadcast_checked, count_words, text_of
from tillroll.operators.joins import pinned

# Weights of the sources in their order, repeating, and the share of all
# words that the mix takes; no target is above CAP times its source.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2

FAN_IN = 64  # documents that one group of the reduction tree is made for
FIRST_GROUPS = 32  # groups of a source on the first level, at least


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``source``, ``source_size``, ``target`` from a table of ``source`` and ``source_size``.

    A target is weight times a common level, at most ``cap`` times the source. Sources by
    capacity over weight: the first that the level leaves below its cap, and all after it,
    share what the capped ones leave. One row per source is windowed, not the documents.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.array(*[F.lit(float(x)) for x in weights])
    t = sizes.select(
        "source",
        "source_size",
        F.get(w, (F.row_number().over(order) - 1) % len(weights)).alias("w"),
        (F.col("source_size") * cap).cast("double").alias("most"),
    )
    everything = Window.partitionBy(F.lit(0))
    filling = Window.orderBy(F.col("most") / F.col("w"), F.col("source").isNull(), "source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    t = t.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(share)).alias("total"),
        F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("capped"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))).alias("w_left"),
        F.row_number().over(filling).alias("at"),
    )
    # the level if this source and all after it are below their caps; the first that holds
    level = (F.col("total") - F.col("capped")) / F.col("w_left")
    holds = F.when(level * F.col("w") <= F.col("most"), F.struct("at", level.alias("level")))
    t = t.select("*", F.min(holds).over(everything)["level"].alias("level"))
    return t.select(
        "source",
        "source_size",
        F.least(F.col("most"), F.coalesce(F.col("level") * F.col("w"), F.col("most"))).alias("target"),
    )


def _unit(*cols) -> Column:
    """A number in [0, 1) from a hash."""
    return (F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) / F.lit(float(1 << 52))).cast("double")


def _round_group(items: Column) -> Column:
    """Run pivotal rounding along an array of (key, size, p, draw). Gives ``done``, the keys
    with their decision, and ``open``, the last document with its probability."""
    none = F.array().cast("array<struct<key:bigint,bit:int>>")
    zero = F.struct(
        F.lit(None).cast("bigint").alias("key"),
        F.lit(0.0).alias("size"),
        F.lit(0.0).alias("p"),
        none.alias("done"),
    )

    def step(acc: Column, x: Column) -> Column:
        a, b = acc["size"] * acc["p"], x["size"] * x["p"]  # word mass
        # mass can go from the open document to x until x is full or the open one empty,
        # or the other way; the odds keep each document's expected mass
        to_x = F.least(a, x["size"] - b)
        to_open = F.least(b, acc["size"] - a)
        forth = x["draw"] * (to_x + to_open) < to_open
        a2 = F.when(forth, a - to_x).otherwise(a + to_open)
        b2 = F.when(forth, b + to_x).otherwise(b - to_open)
        # which of the two has become whole: told by the branch, not by comparing doubles
        x_whole = F.when(forth, x["size"] - b <= a).otherwise(b <= acc["size"] - a)
        x_bit = F.when(forth, 1).otherwise(0)
        open_bit = F.when(forth, 0).otherwise(1)
        whole = F.struct(
            F.when(x_whole, x["key"]).otherwise(acc["key"]).alias("key"),
            F.when(x_whole, x_bit).otherwise(open_bit).alias("bit"),
        )
        later = F.struct(
            F.when(x_whole, acc["key"]).otherwise(x["key"]).alias("key"),
            F.when(x_whole, acc["size"]).otherwise(x["size"]).alias("size"),
            F.when(x_whole, a2 / acc["size"]).otherwise(b2 / x["size"]).alias("p"),
            F.concat(acc["done"], F.array(whole)).alias("done"),
        )
        first = F.struct(x["key"].alias("key"), x["size"].alias("size"), x["p"].alias("p"), none.alias("done"))
        return F.when(acc["key"].isNull(), first).otherwise(later)

    return F.aggregate(items, zero, step)


def _draw_root(items: Column) -> Column:
    """Decide an array of (largest first, key, size, p, draw) one after the other; the
    rounding error of each draw moves the next one's probability, whose mean stays."""
    none = F.array().cast("array<struct<key:bigint,bit:int>>")

    def step(acc: Column, x: Column) -> Column:
        mass = acc["carry"] + x["size"] * x["p"]
        bit = (x["draw"] * x["size"] < mass).cast("int")
        one = F.struct(x["key"].alias("key"), bit.alias("bit"))
        return F.struct((mass - bit * x["size"]).alias("carry"), F.concat(acc["done"], F.array(one)).alias("done"))

    return F.aggregate(items, F.struct(F.lit(0.0).alias("carry"), none.alias("done")), step, lambda acc: acc["done"])


def decide(open_docs: DataFrame, fan_in: int = FAN_IN, first_groups: int = FIRST_GROUPS) -> DataFrame:
    """Round ``key`` (unique long), ``group`` (long), ``size`` (above 0) and ``p`` (strictly
    between 0 and 1) to ``key``, ``bit``."""
    left, found, level = pinned(open_docs), [], 0
    counts = pinned(left.groupBy("group").agg(F.count("*").alias("n")))
    draw = lambda what: _unit("key", F.lit(level), F.lit(what))
    values = lambda: (F.col("size").cast("double").alias("size"), "p", draw("draw").alias("draw"))
    while level == 0 or (counts.agg(F.max("n")).first()[0] or 0) > fan_in:
        leaves = F.ceil(F.col("n") / F.lit(fan_in)).cast("long")
        leaves = F.greatest(leaves, F.lit(first_groups)) if level == 0 else leaves
        grouped = left.join(broadcast_checked(counts), "group").select(
            "group",
            F.pmod(F.xxhash64("key", F.lit(level)), leaves).alias("leaf"),
            F.struct(draw("order").alias("at"), "key", *values()).alias("item"),
        )
        tree = grouped.groupBy("group", "leaf").agg(F.array_sort(F.collect_list("item")).alias("items"))
        tree = pinned(tree.select("group", _round_group(F.col("items")).alias("r")))
        found.append(tree.select(F.explode("r.done").alias("d")).select("d.key", "d.bit"))
        left = tree.select("r.key", "group", "r.size", "r.p")
        counts = pinned(left.groupBy("group").agg(F.count("*").alias("n")))
        level += 1
    root = left.select("group", F.struct((-F.col("size")).alias("at"), "key", *values()).alias("item"))
    root = root.groupBy("group").agg(F.array_sort(F.collect_list("item")).alias("items"))
    found.append(root.select(F.explode(_draw_root(F.col("items"))).alias("d")).select("d.key", "d.bit"))
    return reduce(DataFrame.union, found)


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """One row per document: ``doc_id``, ``rk``, ``tk`` (hashes of id and text), ``nth``
    (numbers rows equal in both), ``size``, ``source_size``, ``target``, ``copies``."""
    table = pinned(
        docs.select(
            docs[doc_id].alias("doc_id"),
            F.xxhash64(docs[doc_id].cast("string")).alias("rk"),
            F.xxhash64(docs[text]).alias("tk"),
            docs[source].alias("source"),
            count_words(text_of(docs[text])).alias("size"),
        )
    )
    sums = table.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(sums, **options).select(
        F.xxhash64(F.col("source").isNull(), F.col("source")).alias("group"), "source_size", "target",
        (F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).alias("rate"),
    )
    # rows of a same id and text are told apart by a number
    twin = Window.partitionBy("rk", "tk").orderBy("group", "size")
    rows = table.select(
        "doc_id", "rk", "tk", "size", F.xxhash64(F.col("source").isNull(), F.col("source")).alias("group")
    ).select("*", (F.row_number().over(twin) - 1).alias("nth"))
    rows = pinned(
        rows.join(broadcast_checked(goals), "group").select(
            "*", F.floor("rate").cast("int").alias("whole"), (F.col("rate") - F.floor("rate")).alias("p"),
            F.xxhash64("rk", "tk", "nth").alias("key"),
        )
    )
    bits = decide(rows.where("size > 0 and p > 0").select("key", "group", "size", "p"))
    return rows.join(bits, "key", "left").select(
        "doc_id", "rk", "tk", "nth", "size", "source_size", "target",
        (F.col("whole") + F.coalesce("bit", F.lit(0))).alias("copies"),
    )


def report(docs: DataFrame, **options) -> DataFrame:
    p = plan(docs, **options)
    return p.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
        F.col("copies").cast("long").alias("copies"),
    )


def mix_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, all columns kept."""
    p = plan(docs, doc_id, text, source, **options).where("copies > 0")
    takes = p.groupBy("rk", "tk").agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    keyed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        F.xxhash64(docs[doc_id].cast("string")).alias("rk"),
        F.xxhash64(docs[text]).alias("tk"),
    )
    twin = Window.partitionBy("rk", "tk").orderBy(F.xxhash64("_row"))
    joined = keyed.join(takes, ["rk", "tk"]).select(
        "_row", "_copies", "_rows", F.row_number().over(twin).alias("_nth"), F.count("*").over(twin.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_of")
    )
    # copies of rows that repeat each other are dealt over them as evenly as can be
    each = F.floor(F.col("_copies") / F.col("_of")) + (F.col("_nth") <= F.col("_copies") % F.col("_of")).cast("int")
    return joined.withColumn("_each", each.cast("int")).where("_each > 0").select(
        "_row", F.explode(F.array_repeat(F.lit(0), F.col("_each")))
    ).select("_row.*")
