"""Centroid clustering with zone maps along a space-filling curve.

Lloyd's rounds over vectors of integers. The vectors are stored once in blocks of neighbours:
they are ordered by their place on a Hilbert curve through the leading directions of the first
centroids, cut into blocks of ``BLOCK`` rows, and each block keeps the least and greatest value
of every component. In a round the box of a block tells which centroids can be nearest to any
vector in it: centroid j is out if the difference of the squared distances to another centroid
i and to j, which is linear in the vector, is negative in the box's worst corner. Only the
centroids that are left are compared with the block's vectors, exactly, by one matrix product;
where one is left, the block's stored sum is taken and no vector is read. Ties go to the
smaller number.

Per round Spark adds up one row of sums per task and cluster; what the driver holds are the
centroids (clusters x components numbers). The order is by curve and a hash of the row's number, so
vectors that are equal, however many, are spread over many partitions.

Defined results: vectors that are null, have another number of components, or hold a null or
a number that is not finite are left out; a component's integer is limited to 64 bits, and a
distance to the largest long; a null id's hash is that of ``1:`` alone; repeated rows stay
repeated, and of equal hashes the vector with the smaller components starts first; fewer kept vectors than
clusters give as many clusters as vectors; an empty table gives no rows. Only the id and vector
columns are used, so other columns, of any name, don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import ship
from tillroll.operators.joins import pinned

CLUSTERS, ROUNDS, COMPONENTS, SCALE = 16, 3, 64, 64
BLOCK = 256
DIRECTIONS, BITS = 9, 7  # of the curve: 63 bits
NARROW = 1 << 22  # products of components below this are exact in doubles
MOST = (1 << 63) - 1

ship(__name__)


def kept(vectors: DataFrame, vec_id: str, embedding: str, components: int) -> DataFrame:
    """``vec_id`` and ``e`` (doubles) of the vectors that take part."""
    e = vectors[embedding].cast("array<double>")
    finite = lambda x: x.isNotNull() & (F.abs(x) < float("inf"))  # noqa: E731 - NaN is the greatest of all
    rows = vectors.select(vectors[vec_id].alias("vec_id"), e.alias("e"))
    return rows.where((F.size("e") == components) & F.forall("e", finite))


def integers(e: Column, scale: int) -> Column:
    """Components as integers, rounded down and limited to 64 bits."""
    return F.transform(
        e,
        lambda x: F.when(x * scale >= 2.0**63, F.lit(MOST))
        .when(x * scale < -(2.0**63), F.lit(-MOST - 1))
        .otherwise(F.floor(x * scale)),
    )


def first_centroids(rows: DataFrame, n: int, scale: int) -> list[list[int]]:
    name = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select(name.alias("h"), integers(F.col("e"), scale).alias("v")).orderBy("h", "v").limit(n)
    return [list(r["v"]) for r in first.collect()]


def directions(centroids: list[list[int]], n: int = DIRECTIONS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The centroids' mean, the ``n`` directions in which they differ most, and the width of a
    cell of the curve in each."""
    c = np.array(centroids, float)
    mean = c.mean(axis=0)
    _, _, axes = np.linalg.svd(c - mean, full_matrices=True)
    axes = axes[:n]
    reach = np.abs((c - mean) @ axes.T).max(axis=0)
    return mean, axes, np.where(reach > 0, reach, 1.0) * 3 / (1 << BITS)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells (``rows x dimensions``, below
    ``2 ** bits``): the bit planes are reflected and turned from the highest down, then read
    as a Gray code."""
    x = cells.astype(np.int64).T.copy()
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[-1] & q, q - 1, 0)
    x ^= turn
    place = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(len(x)):
            place = (place << 1) | ((x[i] >> b) & 1)
    return place


def packed(v: np.ndarray) -> np.ndarray:
    """Integers in the smaller of two widths that holds them."""
    small = not v.size or (v.min() >= -(1 << 15) and v.max() < 1 << 15)
    return np.ascontiguousarray(v, np.int16 if small else np.int64)


def unpacked(raw: bytes, rows: int) -> np.ndarray:
    kind = np.int16 if len(raw) == 2 * rows * COMPONENTS else np.int64
    return np.frombuffer(raw, kind).reshape(rows, -1).astype(np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def placed(rows: DataFrame, curve: tuple, scale: int) -> DataFrame:
    """``vec_id``, the ``place`` on the curve, and the packed integers ``v``."""
    mean, axes, width = curve
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), len(mean))
            at = np.clip(((v - mean) @ axes.T) / width + (1 << (BITS - 1)), 0, (1 << BITS) - 1)
            raw = [packed(x).tobytes() for x in v]
            cells = [batch.column("vec_id"), pa.array(hilbert(at.astype(np.int64), BITS)), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(cells, names=["vec_id", "place", "v"])

    ints = rows.select("vec_id", integers(F.col("e"), scale).alias("v"))
    return ints.mapInArrow(run, f"vec_id {id_type}, place long, v binary")


def along_curve(rows: DataFrame) -> DataFrame:
    """Rows in the order of their place, in partitions of about equal size: the hash of the
    row's number splits places that many rows share."""
    dealt = rows.repartitionByRange("place", F.xxhash64(F.monotonically_increasing_id()))
    return dealt.sortWithinPartitions("place")


def blocks(rows: DataFrame, curve: tuple, scale: int = SCALE, size: int = BLOCK) -> DataFrame:
    """The vectors in blocks of neighbours on the curve, written to the shared folder:
    ``ids``, ``n``, the packed vectors ``v``, the box ``lo`` and ``hi``, and ``total``, the sum
    of the vectors as text."""
    dealt = along_curve(pinned(placed(rows, curve, scale)))
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw = batch.column("vec_id"), batch.column("v").to_pylist()
            out: dict[str, list] = {k: [] for k in ("n", "v", "lo", "hi", "total")}
            starts = range(0, len(raw), size)
            for a in starts:
                v = np.concatenate([unpacked(r, 1) for r in raw[a : a + size]])
                out["n"].append(len(v))
                out["v"].append(packed(v).tobytes())
                out["lo"].append(v.min(axis=0).tobytes())
                out["hi"].append(v.max(axis=0).tobytes())
                out["total"].append([str(x) for x in column_sums(v)])
            if out["n"]:
                bounds = pa.array([*starts, len(raw)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(bounds, ids), pa.array(out["n"], pa.int32())]
                    + [pa.array(out[k], pa.binary()) for k in ("v", "lo", "hi")]
                    + [pa.array(out["total"], pa.list_(pa.string()))],
                    names=["ids", "n", "v", "lo", "hi", "total"],
                )

    schema = f"ids array<{id_type}>, n int, v binary, lo binary, hi binary, total array<string>"
    return pinned(dealt.mapInArrow(run, schema))


def column_sums(v: np.ndarray) -> list[int]:
    """Exact sums of the columns, as Python integers."""
    exact = not v.size or max(-int(v.min()), int(v.max())) < 1 << 40
    return [int(x) for x in (v if exact else v.astype(object)).sum(axis=0)]


def candidates(lo: np.ndarray, hi: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The numbers of the centroids that may be nearest to a vector in the box, in order."""
    wide = max(np.abs(x.astype(float)).max() for x in (lo, hi, c)) >= NARROW
    kind = object if wide else np.int64
    lo, hi, c = lo.astype(kind), hi.astype(kind), c.astype(kind)
    best = int(np.argmin(((2 * c - (lo + hi)) ** 2).sum(axis=1)))
    apart = c - c[best]
    corner = np.where(apart > 0, hi, lo)
    # the most that "distance to best minus distance to j" can be in the box
    gap = (c[best] ** 2).sum() - (c**2).sum(axis=1) + 2 * (corner * apart).sum(axis=1)
    return np.flatnonzero(gap >= 0)


def nearest(v: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, list[int] | np.ndarray]:
    """Index of the nearest row of ``c``, the first of equals, and the squared distance."""
    if max(np.abs(v.astype(float)).max(), np.abs(c.astype(float)).max()) < NARROW:
        v, c = v.astype(float), c.astype(float)  # whole numbers below 2 ** 53 throughout
        score = (c * c).sum(axis=1) - 2 * (v @ c.T)
        at = score.argmin(axis=1)
        return at, (score[np.arange(len(v)), at] + (v * v).sum(axis=1)).astype(np.int64)
    d = np.stack([((v.astype(object) - x) ** 2).sum(axis=1) for x in c.astype(object)], axis=1)
    at = np.array([int(np.argmin(row)) for row in d])
    return at, np.array([min(int(row[i]), MOST) for row, i in zip(d, at)], np.int64)


def _centroid_array(centroids: list[list[int]]) -> np.ndarray:
    return np.array(centroids, np.int64)


def cluster_sums(stored: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Rows and sums of each cluster that is not empty."""
    c = _centroid_array(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [0] * len(c)
        sums = [[0] * c.shape[1] for _ in count]

        def add(j: int, n: int, total: list[int]) -> None:
            count[j] += n
            sums[j] = [x + y for x, y in zip(sums[j], total)]

        for batch in batches:
            for b in batch.to_pylist():
                few = candidates(np.frombuffer(b["lo"], np.int64), np.frombuffer(b["hi"], np.int64), c)
                if len(few) == 1:
                    add(few[0], b["n"], [int(x) for x in b["total"]])
                    continue
                v = unpacked(b["v"], b["n"])
                at, _ = nearest(v, c[few])
                for i in np.unique(at):
                    mine = v[at == i]
                    add(few[i], len(mine), column_sums(mine))
        some = [j for j, n in enumerate(count) if n]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some, pa.int32()),
                pa.array([count[j] for j in some], pa.int64()),
                pa.array([[Decimal(x) for x in sums[j]] for j in some], pa.list_(pa.decimal128(38, 0))),
            ],
            names=["cluster", "n", "s"],
        )

    parts = stored.select("n", "v", "lo", "hi", "total").mapInArrow(run, "cluster int, n long, s array<decimal(38,0)>")
    parts = parts.select("cluster", "n", F.posexplode("s").alias("at", "x"))
    found = parts.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in found:
        out.setdefault(r["cluster"], (r["n"], [0] * c.shape[1]))[1][r["at"]] = int(r["x"])
    return out


def assigned(stored: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance`` of every vector."""
    c = _centroid_array(centroids)
    id_type = stored.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, far = [], []
            rows = batch.select(["n", "v", "lo", "hi"]).to_pylist()
            for b in rows:
                few = candidates(np.frombuffer(b["lo"], np.int64), np.frombuffer(b["hi"], np.int64), c)
                i, d = nearest(unpacked(b["v"], b["n"]), c[few])
                at.append(few[i].astype(np.int32))
                far.append(d)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").flatten(), pa.array(np.concatenate(at)), pa.array(np.concatenate(far))],
                    names=["vec_id", "cluster", "distance"],
                )

    return stored.select("ids", "n", "v", "lo", "hi").mapInArrow(run, f"vec_id {id_type}, cluster int, distance long")


def candidate_counts(stored: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``n`` and ``candidates`` of each block: what the zone maps save."""
    c = _centroid_array(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            few = [
                len(candidates(np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), c))
                for a, b in zip(batch.column("lo").to_pylist(), batch.column("hi").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("n"), pa.array(few, pa.int32())], names=["n", "candidates"])

    return stored.select("n", "lo", "hi").mapInArrow(run, "n int, candidates int")


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE,
            vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """The assignment of every kept vector (written to the shared folder) and the centroids."""
    rows = kept(vectors, vec_id, embedding, COMPONENTS)
    centroids = first_centroids(rows, clusters, scale)
    if not centroids:
        none = rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return pinned(none.limit(0)), []
    stored = blocks(rows, directions(centroids), scale)
    for _ in range(rounds):
        for j, (n, total) in cluster_sums(stored, centroids).items():
            centroids[j] = [x // n for x in total]
    return pinned(assigned(stored, centroids)), centroids


def report(vectors: DataFrame, **options) -> DataFrame:
    """One row per kept vector, with the inertia of its cluster and of all, and the digest of
    its centroid."""
    found, centroids = cluster(vectors, **options)
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r["cluster"]: int(r["i"]) for r in found.groupBy("cluster").agg(wide.alias("i")).collect()}
    each = [min(inertia.get(j, 0), MOST) for j in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of = lambda values, kind: F.get(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster"))
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        of(each, "bigint").alias("cluster_inertia"),
        F.lit(min(sum(inertia.values()), MOST)).cast("long").alias("inertia"),
        of(digest, "string").alias("centroid_sha256"),
    )


def oracle() -> str:
    """The same rows in DuckDB's SQL."""
    steps = [
        f"""kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {COMPONENTS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}
),
c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c
  FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT {CLUSTERS})
)"""
    ]
    distance = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for r in range(ROUNDS + 1):
        steps.append(
            f"""n{r} AS (
  SELECT vec_id, v, arg_min(k, d * {CLUSTERS} + k) AS k, min(d) AS d
  FROM (SELECT rid, vec_id, v, k, {distance} AS d FROM (SELECT row_number() OVER () AS rid, * FROM kept), c{r})
  GROUP BY rid, vec_id, v
)"""
        )
        if r < ROUNDS:
            steps.append(
                f"""c{r + 1} AS (
  SELECT o.k, coalesce(m.c, o.c) AS c
  FROM c{r} o LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
    FROM (
      SELECT k, i, sum(x) AS s, count(*) AS n
      FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM n{r})
      GROUP BY k, i
    )
    GROUP BY k
  ) m ON o.k = m.k
)"""
            )
    last = ROUNDS
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(n.k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY n.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM n{last} n JOIN c{last} c ON n.k = c.k"""
