"""Near-duplicates by Order MinHash, verified by banded alignment.

A text is its sequence of 5-word k-mers (lower-cased), each labelled with its occurrence
number, so no two are equal. A sketch takes the ``ell`` labelled k-mers of least hash and
hashes them in text order: texts agree on it the more, the more k-mers they share in the
same order. Texts that agree on one of the sketches are candidates. Two texts are linked if
an alignment of their k-mers within a band of diagonals matches M of them in order with
M / (a + b - M) >= 0.8, for a and b k-mers; classes are connected components of the links.

How candidates are found without all pairs of a bucket:

1. Equal word sequences are one node; all else works on nodes.
2. Star: in each bucket, all members are compared with its centre only, the member that
   shares most buckets with others. Copies of one text are mostly linked here.
3. Small buckets that still hold more than one component: all pairs of different components.
4. Large ones are put together where they share members, so that a node is in one group, and a
   group is looked at from its consensus, the k-mers that over half of the members have. A
   member x has X(x) k-mers beyond it and lacks A(x) of it. A link from x to c needs
   at most (x + c) / 9 k-mers that only one of them has, which are X(x) + X(c) - 2 s +
   |A(x) - A(c)| or more, where s counts the k-mers beyond the consensus that both have. So
   all members are compared with the one nearest to the consensus; then those that may be
   linked with s = 0 are compared; and for s > 0 members are put into new buckets by their
   k-mers beyond the consensus, of which each needs only the rarest, up to the point where
   s of them can't be left (k-mers that no one else has stand first). Steps 2 to 4 are
   done on the new buckets, after ``MAX_LEVELS`` rounds with all pairs of components.
   No pair of a bucket is lost by this, and no bucket is capped.

Pairs that differ too much in length, or whose 64 one-byte minimum hashes agree in under
``MIN_AGREE``, five standard deviations below 0.8, are not aligned. A pair of similarity 0.8
shares none of the 16 sketches with probability 1e-5, more similar ones with less.

Defined results: null texts and texts without words are no one's duplicate and their class
is their own id; texts of any length are read whole; repeated rows are copies; a null id is
never a class id unless all ids of the class are null; an empty table gives no rows. Extra
columns are kept by :func:`keep_one` and not used.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tillroll.llm.common import broadcast_checked, handed_up, row_key, ship, without_rows
from tillroll.llm.components import components
from tillroll.operators.joins import pinned
from tillroll.session import scratch_scope

K = 5
SIMILARITY = 0.8
ELL, SKETCHES = 3, 16
MIN_HASHES = 64
MIN_AGREE = 35  # of 64
SMALL_BUCKET = 16
MAX_LEVELS = 3
FEW_ROWS = 20_000  # up to which pairs are broadcast

ship(__name__)

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeds(n: int, salt: int) -> np.ndarray:
    return _mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) * _ODD)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        base, inverse = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, b, np.uint64)))) for b in (base, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash of each word of a text: differences of one running sum over its bytes."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    up, down = _powers(len(data) + 1)
    run = np.concatenate(([np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1])))
    return _mix((run[end] - run[start]) * down[start])


def kmers(text: str, k: int = K) -> np.ndarray:
    """Hashes of the occurrence-labelled k-mers in text order; a text with fewer words is
    one k-mer, one without words has none."""
    w = word_hashes(text.lower().encode("utf-8", "replace"))
    if not len(w):
        return w
    width, n = min(k, len(w)), max(1, len(w) - k + 1)
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h = (h + w[i : i + n]) * _ODD
    h = _mix(h)
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    if not new.all():
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        label = np.empty(n, np.uint64)
        label[order] = (np.arange(n) - first).astype(np.uint64)
        h = np.where(label > 0, _mix(h + label * _ODD), h)
    return h


def order_sketches(h: np.ndarray, ell: int, seeds: np.ndarray) -> np.ndarray:
    """One value per seed: the hash, in text order, of the ``ell`` k-mers of least hash."""
    n, take = len(h), min(ell, len(h))
    out = np.empty(len(seeds), np.uint64)
    step = max(1, 2_000_000 // n)  # seeds at a time, so that long texts need little memory
    for at in range(0, len(seeds), step):
        v = _mix(h[None, :] ^ seeds[at : at + step, None])
        least = np.argpartition(v, take - 1, axis=1)[:, :take] if take < n else np.tile(np.arange(n), (len(v), 1))
        least.sort(axis=1)
        picked, value = h[least], np.zeros(len(v), np.uint64)
        for i in range(take):
            value = _mix((value + picked[:, i]) * _ODD)
        out[at : at + step] = value
    return out


def min_bytes(h: np.ndarray, seeds: np.ndarray) -> bytes:
    """The low byte of the least hash under each seed."""
    step = max(1, 2_000_000 // len(h))
    least = [_mix(h[None, :] ^ seeds[at : at + step, None]).min(axis=1) for at in range(0, len(seeds), step)]
    return (np.concatenate(least) & np.uint64(255)).astype(np.uint8).tobytes()


def aligned(a: np.ndarray, b: np.ndarray, least: float) -> int:
    """Most k-mers matched in order by an alignment that stays in the band of diagonals
    which a similarity of ``least`` allows. Labelled k-mers are unique, so matches are
    single points and the longest chain of them is an increasing subsequence."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = int((len(a) + len(b)) * (1 - least) / (1 + least) + 1e-9)
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    if len(i) < least * (len(a) + len(b) - len(i)):
        return len(i)  # too few, in whatever order
    j = j[np.argsort(i)]
    if np.all(j[1:] > j[:-1]):
        return len(j)
    tails: list[int] = []
    for x in j.tolist():
        at = bisect_left(tails, x)
        tails[at : at + 1] = [x]
    return len(tails)


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    m = aligned(a, b, least)
    return m / (len(a) + len(b) - m) if len(a) + len(b) > m else 0.0


def _sketched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From (id columns, text) to (id columns, sketches, node, size, minimum hashes)."""
    seeds, byte_seeds = _seeds(SKETCHES, 1), _seeds(MIN_HASHES, 77)
    for frame in frames:
        out = frame.drop(columns="text")
        nodes, sizes, sketches, least = [], [], [], []
        for text in frame["text"]:
            h = kmers(text or "")
            some = len(h) > 0
            words = b" ".join(text.lower().encode("utf-8", "replace").split()) if some else b""
            sizes.append(len(h))
            sketches.append(order_sketches(h, ELL, seeds).view(np.int64) if some else None)
            nodes.append(hashlib.blake2b(words, digest_size=16).digest() if some else None)
            least.append(min_bytes(h, byte_seeds) if some else None)
        out["omh"], out["node"], out["n"], out["least"] = sketches, nodes, sizes, least
        yield out


def sketch_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    rk, tk = row_key(docs, doc_id, text)
    # ids travel as text: pandas would turn whole numbers with nulls into doubles
    rows = docs.select(rk, tk, docs[doc_id].cast("string").alias("doc_id"), docs[text].alias("text"))
    schema = "_rk long, _tk long, doc_id string, omh array<long>, node binary, n int, least binary"
    found = rows.mapInPandas(_sketched, schema)
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def buckets(nodes: DataFrame) -> DataFrame:
    """``key``, ``node``, ``n``, ``size`` of the buckets with more than one member."""
    members = nodes.select("node", "n", F.posexplode("omh").alias("i", "v")).select(F.xxhash64("i", "v").alias("key"), "node", "n")
    shared = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return members.join(shared, "key")


def _pair(a: str, b: str) -> list:
    return [F.least(F.col(a), F.col(b)).alias("a"), F.greatest(F.col(a), F.col(b)).alias("b")]


def _close(a: str, b: str):
    return F.least(F.col(a), F.col(b)) >= F.greatest(F.col(a), F.col(b)) * SIMILARITY


def with_centre(members: DataFrame) -> DataFrame:
    """Adds the bucket's ``centre`` and its size ``cn``."""
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    centres = members.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node", "n")).alias("c"))
    return members.join(centres.select("key", F.col("c.node").alias("centre"), F.col("c.n").alias("cn")), "key")


def star_pairs(members: DataFrame) -> DataFrame:
    away = members.where((F.col("node") != F.col("centre")) & _close("n", "cn"))
    return away.select(*_pair("node", "centre")).distinct()


def component_pairs(members: DataFrame) -> DataFrame:
    """All pairs of a bucket whose ``comp`` differs."""
    other = members.select("key", F.col("node").alias("node2"), F.col("n").alias("n2"), F.col("comp").alias("comp2"))
    pairs = members.join(other, "key").where((F.col("node") < F.col("node2")) & (F.col("comp") != F.col("comp2")))
    return pairs.where(_close("n", "n2")).select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()


@F.pandas_udf(IntegerType())
def _agree(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), MIN_HASHES) for s in (a, b))
    return pd.Series((x == y).sum(axis=1, dtype=np.int32))


class _Kmers(dict):
    """k-mers by node, kept while few."""

    size = 0

    def of(self, node: bytes, text: str) -> np.ndarray:
        if node not in self:
            if self.size > 1_000_000:
                self.clear()
                self.size = 0
            self[node] = kmers(text)
            self.size += len(self[node])
        return self[node]


def _verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known = _Kmers()
    for frame in frames:
        keep = [
            similarity(known.of(a, ta), known.of(b, tb)) >= SIMILARITY
            for a, b, ta, tb in frame.itertuples(index=False)
        ]
        yield frame.loc[keep, ["a", "b"]]


def _listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"node": frame["node"], "k": [kmers(t).view(np.int64) for t in frame["text"]]})


def one_group(large: DataFrame) -> DataFrame:
    """The members of large buckets, each node once: buckets that share a node are one group,
    named ``centre`` by the least node of its centres and members. A pair of a bucket is in one
    group, and a node's k-mers are listed once, in however many buckets it is."""
    joined = components(large.select("centre", "node").distinct(), "centre", "node")
    nodes = large.select("node", "n").distinct()
    return pinned(nodes.join(joined.toDF("node", "centre"), "node", "left").select(F.coalesce("centre", "node").alias("centre"), "node", "n"))


def consensus(members: DataFrame, texts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """For groups of members (``centre``, ``node``, ``n``): per member ``x`` and ``a``, the
    numbers of k-mers beyond the group's consensus and lacked of it; and ``beyond``, those of its
    k-mers beyond it that two members have at least, with their frequency ``df``, rarest first
    (null: none)."""
    listed = pinned(texts(members.select("node").distinct()).mapInPandas(_listed, "node binary, k array<long>"))
    tokens = members.join(listed, "node").select("centre", "node", F.explode("k").alias("k"))
    size = members.groupBy("centre").agg(F.count("*").alias("size"))
    df = pinned(tokens.groupBy("centre", "k").agg(F.count("*").alias("df")).where("df > 1").join(size, "centre"))
    common = df.where("df * 2 > size").groupBy("centre").agg(F.count("*").alias("common"))
    of = tokens.join(df, ["centre", "k"]).groupBy("centre", "node").agg(
        F.count_if(F.expr("df * 2 > size")).alias("held"),
        F.array_sort(F.collect_list(F.when(F.expr("df * 2 <= size"), F.struct("df", "k")))).alias("beyond"),
    )
    seen = members.join(of, ["centre", "node"], "left").join(common, "centre", "left")
    held, common = F.coalesce("held", F.lit(0)), F.coalesce("common", F.lit(0))
    return pinned(seen.select("centre", "node", "n", (F.col("n") - held).alias("x"), (common - held).alias("a"), "beyond"))


def apart_pairs(seen: DataFrame) -> DataFrame:
    """Pairs of different ``comp`` that can be linked without sharing a k-mer beyond the
    consensus. ``near`` is the component of the member nearest to it."""
    near = seen.where(F.col("x") <= F.col("n") / 4)
    other = near.select(
        "centre", *[F.col(c).alias(f"{c}2") for c in ("node", "n", "x", "a", "comp")]
    )
    pairs = near.where(F.col("comp") != F.col("near")).join(other, "centre").where(
        (F.col("comp") != F.col("comp2"))
        & (F.col("x") + F.col("x2") + F.abs(F.col("a") - F.col("a2")) <= (F.col("n") + F.col("n2")) / 9)
    )
    return pairs.where(_close("n", "n2")).select(*_pair("node", "node2")).distinct()


def finer_buckets(seen: DataFrame) -> DataFrame:
    """Buckets by the k-mers beyond the consensus, of each member the rarest it needs."""
    # of any length allowed for a partner, at most n / 4 k-mers may be unshared, those that no
    # one else has among them
    alone = F.col("x") - F.size("beyond")
    needed = F.greatest(F.floor(F.col("n") / 4) + 1 - alone, F.lit(0)).cast("int")
    placed = seen.where("beyond is not null").select("centre", "node", "n", F.explode(F.slice("beyond", F.lit(1), needed)["k"]).alias("k"))
    placed = placed.select(F.xxhash64("centre", "k").alias("key"), "node", "n")
    return placed.join(placed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key")


def links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are similar. ``texts`` has ``node`` and ``text``."""
    least = nodes.select("node", "least")
    few = pairs.limit(FEW_ROWS + 1).count() <= FEW_ROWS  # a join then moves no other table
    one = (F.broadcast(pairs) if few else pairs).join(least.toDF("a", "la"), "a")
    near = (F.broadcast(one) if few else one).join(least.toDF("b", "lb"), "b")
    near = pinned(near.where(_agree("la", "lb") >= MIN_AGREE).select("a", "b"))
    needed = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    some = pinned(texts(needed))
    both = near.join(some.toDF("a", "ta"), "a").join(some.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")
    return pinned(both.mapInPandas(_verify, "a binary, b binary"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``_rk``, ``_tk``, ``doc_id``, ``class_id`` (the least id of the class) and ``comp`` of
    every document. Numbers of links are not given: members of one class are not all compared
    with each other. Scratch tables go as soon as their level is done; the result is written."""
    whole: list[str] = []
    with scratch_scope(docs.sparkSession) as outer:
        found = handed_up(_classes(docs, doc_id, text, outer), outer, whole)
    return found


def _classes(docs: DataFrame, doc_id: str, text: str, outer: list[str]) -> DataFrame:
    spark = docs.sparkSession
    table = pinned(sketch_table(docs, doc_id, text))
    nodes = pinned(
        table.where("node is not null")
        .groupBy("node")
        .agg(F.min(F.struct("_rk", "_tk")).alias("rep"), F.first("n").alias("n"), F.first("omh").alias("omh"), F.first("least").alias("least"))
    )

    def texts(needed: DataFrame) -> DataFrame:
        """The text of each node, read from one of its documents. The corpus is not shuffled
        as long as the nodes asked for can be broadcast."""
        reps = needed.join(nodes.select("node", F.col("rep._rk").alias("_rk"), F.col("rep._tk").alias("_tk")), "node")
        rk, tk = row_key(docs, doc_id, text)
        found = docs.select(rk, tk, docs[text].alias("text")).join(broadcast_checked(reps), ["_rk", "_tk"])
        return found.select("node", "text").dropDuplicates(["node"])

    comps = tried = None

    def compare(pairs: DataFrame) -> None:
        """Compare pairs not compared before; new links join components."""
        nonlocal comps, tried
        new = pinned(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        if tried is not None and new.isEmpty():
            return
        tried = new if tried is None else tried.union(new)
        linked = links(new, nodes, texts)
        if comps is None:
            comps = pinned(components(linked))
            return
        # components of the components that the new links join, few as a rule
        ends = with_comp(with_comp(linked, "a", "ca"), "b", "cb").select("ca", "cb").where("ca <> cb")
        ends = pinned(ends)
        if ends.isEmpty():
            return
        joined = broadcast_checked(components(ends, "ca", "cb").toDF("comp", "top"))
        before = comps.toDF("node", "comp").union(ends.select(F.explode(F.array("ca", "cb")).alias("node")).select("node", F.col("node").alias("comp")))
        comps = pinned(
            before.distinct().join(joined, "comp", "left").select("node", F.coalesce("top", "comp").alias("component"))
        )

    def with_comp(t: DataFrame, node: str = "node", comp: str = "comp") -> DataFrame:
        return t.join(comps.toDF(node, comp), node, "left").withColumn(comp, F.coalesce(comp, node))

    def mixed(m: DataFrame) -> DataFrame:
        """Members, with their component, of the buckets that hold more than one."""
        m = with_comp(m)
        keys = m.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
        return pinned(m.join(keys, "key", "left_semi"))

    members = pinned(with_centre(buckets(nodes)))
    for level in range(MAX_LEVELS):  # each level is some thirty jobs
        with scratch_scope(spark) as inner:
            compare(star_pairs(members))
            rest = mixed(members)
            large = rest.where(F.col("size") > SMALL_BUCKET)
            if level == MAX_LEVELS - 1 or large.isEmpty():
                compare(component_pairs(rest))
                comps = handed_up(comps, inner, outer)
                break
            group = one_group(large)
            seen = consensus(group, texts)
            nearest = seen.groupBy("centre").agg(F.min(F.struct((F.col("x") + F.col("a")).alias("d"), "node", "n")).alias("m"))
            nearest = pinned(nearest.select("centre", F.col("m.node").alias("nearest"), F.col("m.n").alias("cn")))
            away = seen.drop("beyond").join(nearest, "centre").where((F.col("node") != F.col("nearest")) & _close("n", "cn"))
            away = with_comp(with_comp(away), "nearest", "near").where(F.col("comp") != F.col("near"))
            few = component_pairs(rest.where(F.col("size") <= SMALL_BUCKET))
            compare(away.select(*_pair("node", "nearest")).union(few).distinct())
            labelled = pinned(with_comp(with_comp(seen.drop("beyond").join(nearest, "centre")), "nearest", "near"))
            compare(apart_pairs(labelled))
            members = handed_up(with_centre(finer_buckets(seen)), inner, outer)
            comps, tried = handed_up(comps, inner, outer), handed_up(tried, inner, outer)
    of = nodes.select("node").join(comps.toDF("node", "comp"), "node", "left")
    of = of.select("node", F.coalesce("comp", "node").alias("comp"))
    rows = table.select("_rk", "_tk", "doc_id", "node").join(of, "node", "left")
    first = rows.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("class_id"))
    return rows.join(first, "comp", "left").select(
        "_rk", "_tk", "doc_id",
        F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "comp",
    )


def report(docs: DataFrame, **names) -> DataFrame:
    return classes(docs, **names).select("doc_id", "class_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, the one of least id, all columns unchanged."""
    rows = classes(docs, doc_id, text)
    best = rows.where("comp is not null").groupBy("comp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "_rk", "_tk")).alias("m")
    ).select("comp", F.col("m._rk").alias("brk"), F.col("m._tk").alias("btk"))
    gone = rows.join(best, "comp").where("_rk <> brk or _tk <> btk").select("_rk", "_tk").distinct()
    left = without_rows(docs, gone, doc_id, text)
    # rows that repeat the one that stays
    twice = rows.where("comp is not null").groupBy("_rk", "_tk").agg(F.count("*").alias("c")).where("c > 1")
    if twice.isEmpty():
        return left
    place = Window.partitionBy("_rk", "_tk").orderBy(F.xxhash64("_row"))
    rk, tk = row_key(left, doc_id, text)
    packed = left.select(F.struct(*[left[c] for c in left.columns]).alias("_row"), rk, tk)
    wordless = F.coalesce(F.regexp_like(F.col("_row")[text], F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    return packed.withColumn("_nth", F.row_number().over(place)).where((F.col("_nth") == 1) | ~wordless).select("_row.*")
