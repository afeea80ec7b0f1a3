"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Each document gets a vector of transformed statistics. Per (language, source) group the
minimum-covariance-determinant estimate of centre and scatter is found by concentration steps:
keep the rows whose squared Mahalanobis distance is within the group's ``support`` quantile,
re-estimate from them, repeat until no group's log-determinant falls by ``tolerance`` any more
(at most ``steps`` times). There are three deterministic starts: medians with absolute
deviations, the correlations of the values clipped about the median, and the plain mean and
covariance; each group takes the estimate of least determinant of all starts and steps. A
document whose distance by it is above ``cutoff`` is rejected. Built-in functions only.

Groups with fewer than ``min_group`` rows are pooled by language, and what is still small
into one group. Every scatter gets ``floor`` squared added on its diagonal, so a statistic
that is constant in a group doesn't reject small departures from it.

Defined results: a null text has no words and fails the base rules; null language or source
is a value of its own; long texts are read whole; repeated rows get the same verdict; an
empty table gives no rows. Extra columns are kept by :func:`keep_good` and not used.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import (
    SPACE_CHARS,
    broadcast_checked,
    count_chars,
    let,
    row_key,
    split_words,
    text_of,
    without_rows,
)
from tillroll.operators.joins import pinned

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# The vector: log of the mean word length, and square roots of shares, all with a prior of
# 50 words (or 5 lines) so that short texts are not outliers by chance.
VECTOR = ("x_word", "x_symbol", "x_line", "x_repeat", "x_upper")
FLOOR = (0.06, 0.08, 0.08, 0.08, 0.08)
SUPPORT = 0.75
STEPS = 20  # a bound that the tolerance ends before
TOLERANCE = 0.001
CLIP = 2.0  # of the second start, in deviations
CUTOFF = 45.0  # a normal vector of five coordinates exceeds it with probability 1.4e-8
MIN_GROUP = 60


def repeat_words(words: Column) -> Column:
    """Words in 5-word windows found twice or more in the text, the first included.

    Windows are compared by a 64-bit hash. Texts whose windows all differ end there; else
    the windows are sorted by hash, those next to an equal one are repeated, and the words
    they cover are counted along their positions.
    """

    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
        same = lambda s, e, j: (F.get(s, j - 1)["v"] == e["v"]) | (F.get(s, j + 1)["v"] == e["v"])
        places = let(ordered, lambda s: F.filter(s, lambda e, j: F.coalesce(same(s, e, j), F.lit(False))))
        places = F.array_sort(F.transform(places, lambda e: e["i"]))
        zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        step = lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")
        )
        return F.aggregate(places, zero, step, lambda acc: acc["n"])

    def windows(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    found = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: let(
            windows(h), lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0)
        ),
    )
    return F.when(F.size(words) > WINDOW, found).otherwise(0).cast("long")


def statistics(docs: DataFrame, text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """The base statistics and the vector, next to the columns of ``keep``."""
    rows = docs.select(*(keep or []), text_of(docs[text]).alias("_t"))
    kept = [c for c in rows.columns if c != "_t"]
    rows = rows.withColumns({"_w": split_words(F.col("_t")), "_l": F.filter(F.split("_t", "\n"), lambda s: F.regexp_like(s, F.lit(r"[^\x20\x09-\x0D]")))})
    rows = rows.select(
        *kept,
        F.size("_w").cast("long").alias("n_words"),
        (F.length("_t") - count_chars(F.col("_t"), SPACE_CHARS)).cast("long").alias("word_chars"),
        count_chars(F.col("_t"), SYMBOLS).alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_w")).alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        count_chars(F.col("_t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
    )
    n = F.col("n_words") + 50.0
    return rows.withColumns(
        {
            "x_word": F.log((F.col("word_chars") + 250.0) / n),
            "x_symbol": F.sqrt(F.col("n_symbols") / n),
            "x_line": F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 5.0)),
            "x_repeat": F.sqrt(F.col("n_repeat_words") / n),
            "x_upper": F.sqrt(F.col("n_upper") / (F.col("word_chars") + 250.0)),
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT),
        }
    )


def _gamma_p(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function by its series."""
    term = total = 1.0 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def consistency(d: int, support: float) -> float:
    """Factor that makes the scatter of the central ``support`` of a normal sample that of
    the whole sample."""
    lo, hi = 0.0, 200.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _gamma_p(d / 2, mid / 2) < support else (lo, mid)
    return support / _gamma_p(d / 2 + 1, lo / 2)


def with_distance(rows: DataFrame, x: tuple[str, ...] = VECTOR) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance, from ``centre`` and ``factor`` (the
    scatter's Cholesky factor, lower triangle, row-major) by forward substitution, one
    coordinate after the other."""
    for i, name in enumerate(x):
        low = i * (i + 1) // 2
        y = F.col(name) - F.get("centre", F.lit(i))
        for j in range(i):
            y = y - F.get("factor", F.lit(low + j)) * F.col(f"_y{j}")
        rows = rows.withColumn(f"_y{i}", y / F.get("factor", F.lit(low + i)))
    total = sum((F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(1, len(x))), F.col("_y0") * F.col("_y0"))
    return rows.withColumn("d2", total).drop(*[f"_y{i}" for i in range(len(x))])


def _factor(groups: DataFrame, d: int) -> DataFrame:
    """Cholesky factor of each group's ``cov`` (lower triangle) as ``factor``. One row per
    group; entries are rounded so that the order of summation doesn't show."""
    at = lambda i, j: i * (i + 1) // 2 + j
    for i in range(d):
        for j in range(i + 1):
            s = F.get("cov", F.lit(at(i, j)))
            for k in range(j):
                s = s - F.col(f"_l{i}_{k}") * F.col(f"_l{j}_{k}")
            groups = groups.withColumn(f"_l{i}_{j}", F.sqrt(F.greatest(s, F.lit(1e-12))) if i == j else s / F.col(f"_l{j}_{j}"))
    names = [f"_l{i}_{j}" for i in range(d) for j in range(i + 1)]
    logdet = sum((2 * F.log(f"_l{i}_{i}") for i in range(1, d)), 2 * F.log("_l0_0"))
    groups = groups.withColumn("factor", F.array(*[F.round(F.col(n), 12) for n in names]))
    return groups.withColumn("logdet", F.round(logdet, 9)).drop(*names, "cov")


def _moments(x: tuple[str, ...]) -> list[Column]:
    d = len(x)
    return [
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)],
        *[F.avg(F.col(x[i]) * F.col(x[j])).alias(f"s{i}_{j}") for i in range(d) for j in range(i + 1)],
    ]


def _scatter(means: DataFrame, d: int, factor: float, floor: tuple[float, ...]) -> DataFrame:
    """``centre`` and ``cov`` from the moments of each group and start."""
    cov = [
        (F.col(f"s{i}_{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * factor + (floor[i] ** 2 if i == j else 0.0)
        for i in range(d)
        for j in range(i + 1)
    ]
    return means.select(
        "gid",
        "start",
        F.array(*[F.round(F.col(f"m{i}"), 9) for i in range(d)]).alias("centre"),
        F.array(*[F.round(c, 9) for c in cov]).alias("cov"),
    )


def starts(rows: DataFrame, x: tuple[str, ...], floor: tuple[float, ...]) -> DataFrame:
    """``gid``, ``start``, ``centre``, ``cov`` of the three starts."""
    d = len(x)
    middle = rows.groupBy("gid").agg(*[F.percentile_approx(c, 0.5, 1000).alias(f"c{i}") for i, c in enumerate(x)])
    middle = broadcast_checked(middle)
    spread = rows.join(middle, "gid").groupBy("gid").agg(
        *[F.first(f"c{i}").alias(f"c{i}") for i in range(d)],
        *[(F.percentile_approx(F.abs(F.col(c) - F.col(f"c{i}")), 0.5, 1000) * 1.4826).alias(f"a{i}") for i, c in enumerate(x)],
    )
    spread = pinned(spread)
    cov = [
        (F.pow(F.col(f"a{i}"), 2) + floor[i] ** 2) if i == j else F.lit(0.0) for i in range(d) for j in range(i + 1)
    ]
    centre = F.array(*[F.col(f"c{i}") for i in range(d)])
    medians = spread.select("gid", F.lit(0).alias("start"), centre.alias("centre"), F.array(*cov).alias("cov"))

    def clipped(i: int) -> Column:
        reach = CLIP * F.greatest(F.col(f"a{i}"), F.lit(floor[i]))
        return F.least(F.greatest(F.col(x[i]), F.col(f"c{i}") - reach), F.col(f"c{i}") + reach)

    near = rows.join(broadcast_checked(spread), "gid").select("gid", F.lit(1).alias("start"), *[clipped(i).alias(c) for i, c in enumerate(x)])
    plain = rows.select("gid", F.lit(2).alias("start"), *x)
    return medians.union(_scatter(near.union(plain).groupBy("gid", "start").agg(*_moments(x)), d, 1.0, floor))


def fit(rows: DataFrame, x: tuple[str, ...] = VECTOR, support: float = SUPPORT, steps: int = STEPS,
        floor: tuple[float, ...] = FLOOR, tolerance: float = TOLERANCE) -> DataFrame:
    """``gid``, ``centre``, ``factor``, ``logdet`` of each group of ``rows`` (``gid`` and the
    vector): of all starts and concentration steps the one of least determinant. A step takes
    the starts that still fall through two aggregates of the narrow rows, with map-side partial
    results; one row per group and start is written after it, and one number comes back."""
    d = len(x)
    scale = consistency(d, support)
    now = pinned(_factor(starts(rows, x, floor), d).withColumn("logdet", F.lit(None).cast("double")))
    seen = []
    for _ in range(steps):
        model = broadcast_checked(now.select("gid", "start", "centre", "factor"))
        far = with_distance(rows.join(model, "gid"), x).select("gid", "start", *x, "d2")
        near = far.groupBy("gid", "start").agg(F.percentile_approx("d2", support, 1000).alias("q"))
        kept = far.join(broadcast_checked(near), ["gid", "start"]).where("d2 <= q")
        after = _factor(_scatter(kept.groupBy("gid", "start").agg(*_moments(x)), d, scale, floor), d)
        before = now.select("gid", "start", F.col("logdet").alias("_before"))
        after = pinned(after.join(before, ["gid", "start"]))
        seen.append(after.drop("_before"))
        now = after.where(F.col("_before").isNull() | (F.col("logdet") < F.col("_before") - tolerance)).drop("_before")
        if now.isEmpty():
            break
    best = reduce(DataFrame.union, seen).groupBy("gid").agg(F.min(F.struct("logdet", "start", "centre", "factor")).alias("m"))
    return best.select("gid", "m.centre", "m.factor", "m.logdet")


def groups(rows: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """``lang``, ``source``, ``gid``: the group of each pair of values."""
    n = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    n = n.withColumn("small", F.col("n") < min_group)
    by_lang = Window.partitionBy("lang", "small")
    n = n.withColumn("pooled", F.sum("n").over(by_lang))
    return n.select(
        "lang",
        "source",
        F.when(~F.col("small"), F.to_json(F.struct(F.lit(1).alias("k"), "lang", "source")))
        .when(F.col("pooled") >= min_group, F.to_json(F.struct(F.lit(2).alias("k"), "lang")))
        .otherwise("{}")
        .alias("gid"),
    )


def judge(docs: DataFrame, cutoff: float = CUTOFF, text: str = "text", lang: str = "lang", source: str = "source",
          keep: list[Column] | None = None, **options) -> DataFrame:
    """Statistics, ``base_failed``, ``d2`` and ``kept`` of each document, next to ``keep``."""
    keep = keep or []
    rows = pinned(statistics(docs, text, [*keep, docs[lang].alias("_lang"), docs[source].alias("_source")]))
    rows = rows.withColumn("_g", F.xxhash64(F.col("_lang").isNull(), F.col("_lang"), F.col("_source").isNull(), F.col("_source")))
    good = rows.where(~F.col("base_failed"))
    gids = pinned(groups(good.select(F.col("_lang").alias("lang"), F.col("_source").alias("source"))))
    gids = gids.select(F.xxhash64(F.col("lang").isNull(), "lang", F.col("source").isNull(), "source").alias("_g"), "gid")
    gids = broadcast_checked(gids)
    vectors = pinned(good.join(gids, "_g").select("gid", *VECTOR))
    model = pinned(fit(vectors, **options))
    judged = with_distance(rows.join(gids, "_g", "left").join(broadcast_checked(model), "gid", "left"))
    return judged.withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= cutoff)
    ).drop("_g", "_lang", "_source", "centre", "factor", "logdet")


def report(docs: DataFrame, **options) -> DataFrame:
    judged = judge(docs, keep=[docs["doc_id"]], **options)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("d2", 4).alias("distance2"),
    )


def keep_good(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are kept, all columns unchanged."""
    keys = row_key(docs, doc_id, text)
    bad = judge(docs, text=text, keep=keys, **options).where("not kept").select("_rk", "_tk").distinct()
    return without_rows(docs, bad, doc_id, text)
