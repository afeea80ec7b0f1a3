"""Secret scan: fixed patterns plus character Markov models compared by log-likelihood ratio.

Two first-order character models are trained from labelled samples, one on random strings
and one on ordinary identifiers. Candidates are runs of ``MIN_RUN`` or more characters of the
models' alphabet, without what the fixed patterns have found in them. Of each the stretch with
the greatest log-likelihood ratio is taken, by a running sum that starts anew where it falls
below zero, so a secret glued to a path or a name stands out. It is reported when it has
``MIN_RUN`` characters and a ratio of ``min_llr`` nats. Built-in column functions only.

Defined results: a null text is the empty text and has no span; texts of any length are
read whole; repeated rows give repeated results; an empty table gives no rows. Only the id
and text columns are used, so other columns, of any name, don't matter. With no samples of
a class the smoothed model of that class is uniform.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import let, text_of
from tillroll.operators.joins import pinned

# The kinds in their order of listing and their patterns.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # the maximal runs of AKIA[A-Z0-9]+ that have 18 characters
HEX = r"[0-9a-f]{16,}"
ASSIGN_MIN = 12

# Candidates of the Markov method and the alphabet of its models.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_RUN = 12
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}"

SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def spans(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, kind, end, value) in code points.

    The text between matches and the matches themselves alternate, so running sums of
    their lengths are the positions. ``value`` is the given group.
    """
    none = F.array().cast(SPAN)
    pieces = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["p"])
        end = begin + F.length(x["h"])
        one = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["v"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    # the last piece stands after the last match and has no position to give
    parts = F.filter(
        F.arrays_zip(pieces.alias("p"), hits.alias("h"), values.alias("v")), lambda x: x["h"].isNotNull()
    )
    found = F.aggregate(parts, start, step, lambda acc: acc["out"])
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(none)


def base_spans(text: Column) -> Column:
    assign = F.filter(spans(text, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= ASSIGN_MIN)
    return F.array_sort(F.concat(assign, spans(text, ACCESS, 1), spans(text, HEX, 2)))


def train(samples: DataFrame, smoothing: float = 0.5, floor: float = 0.02) -> list[float]:
    """Log ratios of the transition probabilities, random over ordinary, one per pair of
    characters of the alphabet, row-major. A share ``floor`` of each model is uniform, so that a
    pair which one sample lacks is no proof by itself.

    ``samples`` has ``value`` (string), ``random`` (boolean) and, if a value stands for
    several, ``n``. The counts are aggregated by Spark, by value first; only the table over
    pairs of characters, 67 x 67 at most, is collected.
    """
    k = len(ALPHABET)
    times = F.sum("n") if "n" in samples.columns else F.count("*")
    values = samples.where("value is not null and random is not null").groupBy("random", "value").agg(times.alias("n"))
    pairs = values.select("random", "n", F.split("value", "").alias("c")).select(
        "random",
        "n",
        F.explode(
            F.expr("transform(sequence(1, greatest(size(c) - 1, 1)), i -> struct(get(c, i - 1) as a, get(c, i) as b))")
        ).alias("p"),
    )
    counts = {
        (r["random"], r["i"], r["j"]): r["n"]
        for r in pairs.select(
            "random",
            "n",
            F.expr(f"locate(p.a, '{ALPHABET}')").alias("i"),
            F.expr(f"locate(p.b, '{ALPHABET}')").alias("j"),
        )
        .where("i > 0 and j > 0")
        .groupBy("random", "i", "j")
        .agg(F.sum("n").alias("n"))
        .collect()
    }
    out = []
    for i in range(1, k + 1):
        total = {c: smoothing * k + sum(counts.get((c, i, j), 0) for j in range(1, k + 1)) for c in (True, False)}
        for j in range(1, k + 1):
            p, q = ((1 - floor) * (counts.get((c, i, j), 0) + smoothing) / total[c] + floor / k for c in (True, False))
            out.append(math.log(p / q))
    return out


def stretch(run: Column, model: Column) -> Column:
    """The stretch of a run with the greatest log-likelihood ratio under the two models: a span
    with its ``llr`` in nats. Of equal ones the first is taken."""
    at = F.transform(F.split(run["value"], ""), lambda c: F.call_function("locate", c, F.lit(ALPHABET)))

    def step(a: Column, acc: Column, i: Column) -> Column:
        weight = F.coalesce(F.get(model, (F.get(a, i - 1) - 1) * len(ALPHABET) + F.get(a, i) - 1), F.lit(0.0))
        fresh = acc["sum"] <= 0
        return let(
            F.struct(
                (F.when(fresh, 0.0).otherwise(acc["sum"]) + weight).alias("sum"),
                F.when(fresh, i - 1).otherwise(acc["first"]).alias("first"),
            ),
            lambda now: F.struct(
                now["sum"].alias("sum"),
                now["first"].alias("first"),
                F.greatest(acc["best"], now["sum"]).alias("best"),
                F.when(now["sum"] > acc["best"], now["first"]).otherwise(acc["start"]).alias("start"),
                F.when(now["sum"] > acc["best"], i + 1).otherwise(acc["end"]).alias("end"),
            ),
        )

    none = [F.lit(0.0).alias("sum"), F.lit(0).alias("first"), F.lit(0.0).alias("best"), F.lit(0).alias("start"), F.lit(0).alias("end")]
    best = let(
        at,
        lambda a: F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.size(a) - 1, F.lit(1))), F.struct(*none), lambda acc, i: step(a, acc, i)
        ),
    )
    return let(
        best,
        lambda b: F.struct(
            (run["start"] + b["start"]).alias("start"),
            run["kind"].alias("kind"),
            (run["start"] + b["end"]).alias("end"),
            F.substring(run["value"], b["start"] + 1, b["end"] - b["start"]).alias("value"),
            b["best"].alias("llr"),
        ),
    )


def outside(run: Column, base: Column) -> Column:
    """The parts of a run that no base span covers. ``base`` is sorted by start."""
    piece = lambda a, b: F.struct(
        a.alias("start"), run["kind"].alias("kind"), b.alias("end"),
        F.substring(run["value"], a - run["start"] + 1, b - a).alias("value"),
    )
    start = F.struct(run["start"].alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, b: Column) -> Column:
        left = F.when(b["start"] > acc["at"], F.array(piece(acc["at"], b["start"]))).otherwise(F.array().cast(SPAN))
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.concat(acc["out"], left).alias("out"))

    def finish(acc: Column) -> Column:
        last = F.when(acc["at"] < run["end"], F.array(piece(acc["at"], run["end"]))).otherwise(F.array().cast(SPAN))
        return F.concat(acc["out"], last)

    over = F.filter(base, lambda b: (b["start"] < run["end"]) & (b["end"] > run["start"]))
    return let(over, lambda o: F.when(F.size(o) == 0, F.array(run)).otherwise(F.aggregate(o, start, step, finish)))


def model_column(model: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{x:.9g}" for x in model)), ",").cast("array<double>")


def join_spans(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def scan(docs: DataFrame, model: list[float], min_llr: float = 18.0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All spans of each document: ``doc_id``, ``base`` and ``found`` (base spans plus those
    that the models add beside them)."""
    table = docs.select(docs[doc_id].alias("doc_id"), text_of(docs[text]).alias("text"))
    table = table.select("doc_id", base_spans(F.col("text")).alias("base"), spans(F.col("text"), CANDIDATE, 3).alias("runs"))
    weights = model_column(model)
    parts = F.flatten(F.transform("runs", lambda r: outside(r, F.col("base"))))
    scored = F.transform(F.filter(parts, lambda r: F.length(r["value"]) >= MIN_RUN), lambda r: stretch(r, weights))
    good = F.filter(scored, lambda r: (r["end"] - r["start"] >= MIN_RUN) & (r["llr"] >= min_llr))
    added = F.transform(good, lambda r: r.dropFields("llr"))
    return table.select(
        "doc_id",
        "base",
        F.when(F.size("runs") > 0, F.array_sort(F.concat("base", added))).otherwise(F.col("base")).alias("found"),
    )


def corpus_samples(docs: DataFrame, n_docs: int = 2000, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Labelled samples from a corpus: about ``n_docs`` different documents, those whose hash of
    id and text is below the share of ``n_docs`` in all rows; each task picks its own, and they
    are written once. Random: values of the fixed patterns and digests of the document in
    hexadecimal and base 64. Ordinary: the words that hold no such value, alone, in capitals and
    as parts of paths and compound names, and decimal numbers."""
    table = docs.select(docs[doc_id].alias("id"), text_of(docs[text]).alias("text"))
    share = min(1.0, n_docs / max(1, docs.count()))
    below = F.pmod(F.xxhash64(F.col("id").cast("string"), "text"), F.lit(1 << 40)) < int(share * (1 << 40))
    some = pinned(table.where(below).dropDuplicates(["id", "text"]))
    some = some.select("text", base_spans(F.col("text")).alias("base"))
    digest = F.sha2("text", 256)
    random = some.select(
        F.explode(
            F.concat(
                F.transform("base", lambda s: s["value"]),
                F.array(digest, F.upper(digest), F.base64(F.unhex(digest)), F.base64(F.unhex(F.sha2(digest, 384)))),
            )
        ).alias("value"),
        F.lit(True).alias("random"),
    )
    words = F.regexp_extract_all("text", F.lit(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z][A-Za-z0-9_-]*"), F.lit(0))
    plain = some.where(F.size("base") == 0)
    known = plain.select(F.explode(words).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    first, last, upper = F.upper(F.substring("w", 1, 1)), F.substring("w", -1, 1), F.upper("w")
    forms = [F.col("w"), *[F.concat(F.lit(c), "w", F.lit(c)) for c in "/_-"], F.concat(F.lit("_"), upper, F.lit("_"))]
    forms.append(F.concat(last, first, F.expr("substring(w, 2)")))  # as after another word in a compound
    ordinary = known.select(F.explode(F.array(*forms)).alias("value"), F.lit(False).alias("random"), "n")
    numbers = plain.select(F.crc32(F.col("text").cast("binary")).cast("string").alias("value"), F.lit(False).alias("random"), F.lit(1).alias("n"))
    return random.withColumn("n", F.lit(1).cast("long")).union(ordinary).union(numbers)


def report(docs: DataFrame, model: list[float], **options) -> DataFrame:
    """The digest columns of the scan: counts per fixed kind, the hash of the base spans and
    all spans as text."""
    found = scan(docs, model, **options)
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(join_spans(F.col("base")), 256).alias("base_sha256"),
        join_spans(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s["kind"] == 3)).cast("long").alias("n_markov"),
    )
