"""Clustering against SQL and against plain loops over all vectors and centroids."""

from __future__ import annotations

import collections
import hashlib
import math
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tillroll.llm import curve_clusters
from tillroll.llm.common import table
from tillroll.llm.queries import ORACLE_SQL, op12_curve_clusters

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, clusters=16, rounds=3):
    """All distances in Python's integers."""
    kept = []
    for i, e in rows:
        if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, [max(-(1 << 63), min((1 << 63) - 1, math.floor(64 * x) if math.isfinite(64 * x) else (1 << 63) * (1 if x > 0 else -1))) for x in e]))
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    c = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((x - y) ** 2 for x, y in zip(v, k)) for k in c]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = assign()
        for j in range(len(c)):
            mine = [v for (_, v), (k, _) in zip(kept, at) if k == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    most = (1 << 63) - 1
    at = [(k, min(d, most)) for k, d in assign()]
    inertia = collections.Counter()
    for k, d in at:
        inertia[k] += d
    digest = [hashlib.sha256(",".join(map(str, k)).encode()).hexdigest() for k in c]
    return collections.Counter(
        (i, k, d, min(inertia[k], most), min(sum(inertia.values()), most), digest[k]) for (i, _), (k, d) in zip(kept, at)
    )


def counted(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = collections.Counter(con.execute(ORACLE_SQL["op12_curve_clusters"]).fetchall())
    assert counted(op12_curve_clusters(spark, SF)) == want


def test_odd_vectors_against_loops(spark):
    rnd = random.Random(3)
    vector = lambda: [rnd.gauss(0, 0.2) for _ in range(64)]
    same = vector()
    rows = [(i, vector()) for i in range(60)] + [(100 + i, same) for i in range(40)] + [(7, same), (7, same), (None, vector()), (None, same)]
    rows += [(200, None), (201, []), (202, same[:63]), (203, same + [0.1]), (204, [None, *same[1:]]), (205, [float("nan"), *same[1:]]), (206, [float("inf"), *same[1:]])]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("place", "v", "n", "ids", "cluster", "distance", "e")})
    assert counted(curve_clusters.report(df)) == brute(rows)
    few = rows[:5] + rows[104:]
    assert counted(curve_clusters.report(spark.createDataFrame(few, SCHEMA))) == brute(few)
    assert curve_clusters.report(df.limit(0)).count() == 0
    assert curve_clusters.report(df.where("vec_id >= 200")).count() == 0


def test_huge_components_stay_exact(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.choice([1e5, -3e7, 1e12, 0.5, 1e300, -1e308]) if rnd.random() < 0.1 else rnd.gauss(0, 1) for _ in range(64)]) for i in range(40)]
    assert counted(curve_clusters.report(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_curve_visits_every_cell_in_steps_of_one():
    for bits, dims in ((3, 2), (2, 3), (1, 5), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        place = curve_clusters.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        path = cells[np.argsort(place)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_boxes_never_lose_the_nearest_centroid():
    rng = np.random.default_rng(5)
    fewer = 0
    for _ in range(300):
        k, d = rng.integers(2, 10), rng.integers(1, 6)
        c = rng.integers(-20, 20, (k, d))
        v = rng.integers(-20, 20, d) + rng.integers(-3, 4, (30, d))
        few = curve_clusters.candidates(v.min(axis=0), v.max(axis=0), c)
        at, far = curve_clusters.nearest(v, c[few])
        all_far = ((v[:, None] - c[None]) ** 2).sum(axis=2)
        assert (few[at] == all_far.argmin(axis=1)).all() and (far == all_far.min(axis=1)).all()
        fewer += len(few) < k
    assert fewer > 100


def test_zone_maps_of_grouped_vectors_leave_few_centroids(spark):
    """Vectors around a few points: a third of all comparisons is left at most."""
    rnd = random.Random(6)
    points = [[rnd.gauss(0, 1) for _ in range(64)] for _ in range(16)]
    rows = [(i, [x + rnd.gauss(0, 0.02) for x in points[i % 16]]) for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = curve_clusters.kept(df, "vec_id", "embedding", 64)
    centroids = [[math.floor(64 * x) for x in p] for p in points]
    stored = curve_clusters.blocks(kept, curve_clusters.directions(centroids), size=64)
    got = curve_clusters.candidate_counts(stored, centroids).collect()
    assert sum(r.n for r in got) == 4000
    assert sum(r.n * r.candidates for r in got) < 4000 * 16 / 3


def test_a_common_vector_is_spread_over_partitions(spark):
    rows = spark.range(6000).select(F.col("id").alias("vec_id"), F.expr("transform(sequence(1, 64), i -> if(id % 3 = 0, 0.25D, pmod(hash(id, i), 1000) / 1000D))").alias("embedding"))
    kept = curve_clusters.kept(rows.repartition(8), "vec_id", "embedding", 64)
    first = curve_clusters.first_centroids(kept, 16, 64)
    placed = curve_clusters.placed(kept, curve_clusters.directions(first), 64)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        dealt = curve_clusters.along_curve(placed).withColumn("p", F.spark_partition_id())
        most = dealt.groupBy("p").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set(key, before)
    assert most < 2000


def test_whole_table(spark):
    small = table(spark, "/root/testdata/sf0.001", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in small.collect()]
    assert counted(curve_clusters.report(small)) == brute(rows)


