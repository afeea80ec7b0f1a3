"""Benchmark decontamination by template windows.

Words become templates: numbers, names and units are replaced with typed placeholders, other
words are lower-cased without punctuation. Windows of template words of the benchmark are
hash-joined with those of the documents, so a question with other numbers or names in it
still matches; windows of plain words are in the same join, so a verbatim copy matches
whatever its words are and whatever stands around it. Matches of one document and item are put together whose alignments (document
position minus item position) differ by a few words at most, so words put in, left out or
split don't break an item. The slot values under them, and no others, must then be
consistent: a value of the item always became the same value of the document and no two
became one. Slots outside the best such mapping (verbatim ones first) deviate. Words are read
by built-in functions; the hashes of a document's windows are combined from those of its words in
Arrow batches, and go into the join unless a table of bits says that no item has them.

A document is reported for an item if windows in one band of alignments cover at least
``min_cover`` of the item's words and no slot deviates, or ``min_run`` words without the
deviating ones, of which there may be one, or a quarter of the slots. What is covered counts
in the item and in the document, and the smaller number holds.

Defined results: null and empty texts match nothing; items of fewer than ``MIN_ITEM`` words
match word for word only; texts of any length are compared whole; repeated documents are reported once per
id, repeated items by their ids; empty tables give no rows. Extra columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tillroll.llm.common import broadcast_checked, let, row_key, ship, split_words, text_of, without_rows
from tillroll.operators.joins import pinned

WINDOW = 8
SHORT_ITEM, SHORT_WINDOW = 25, 5  # items of fewer words have shorter windows
TINY_ITEM, LEAST_WINDOW = 11, 3  # and of still fewer plain words
MIN_ITEM = 5  # shorter ones match as plain words only
BAND = 6  # words put in or left out between the matches of one place
MIN_LITERAL = 3  # words of a window that are no placeholders
MIN_COVER = 0.7
MIN_RUN = 25
MAX_DEVIATING = 0.25  # of the slots under a long run; one in any case
SENTENCE_ENDS = ".!?:|"
BARE, UP, ENDS, IS_NUMBER = 1, 2, 4, 8  # flags of a word: has a letter or digit, a capital, ends a sentence
FILTER_BITS = 1 << 22  # of a table that rules out most windows before the join
WORDS_AT_ONCE = 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)

ship(__name__)

# Placeholders, and unit words that count as units after a number.
NUMBER, NAME, UNIT = "§n", "§p", "§u"
UNITS = (
    "mm cm m km mg g kg t ml l s sec second seconds min minute minutes h hour hours day days week weeks month months "
    "year years inch inches foot feet yard yards mile miles ounce ounces pound pounds gallon gallons dollar dollars "
    "cent cents euro euros percent degree degrees meter meters metre metres kilometer kilometers kilometre kilometres "
    "gram grams kilogram kilograms liter liters litre litres"
).split()


def _plain(words: Column) -> Column:
    """Lower-cased words in one text without punctuation, but for words of nothing else, so
    words stay in their places."""
    rest = r"[^\p{L}\p{N}\x20\x09-\x0D]+"
    return F.regexp_replace(F.lower(F.array_join(words, " ")), rf"(?<=[\p{{L}}\p{{N}}]){rest}|{rest}(?=[\p{{L}}\p{{N}}])", "")


def _trimmed(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def _is_number(word: Column) -> Column:
    return F.regexp_like(word, F.lit(r"^[^\p{L}\p{N}]*\p{Nd}"))


def readings(words: Column) -> Column:
    """Of each word its template word ``t``, its plain word ``e`` (numbers by value, other
    words without punctuation, those of nothing else as they are), ``bare``, and whether it
    begins with a capital (``up``)."""
    units = F.array(*[F.lit(u) for u in UNITS])
    starts = lambda w, a, b: (w >= a) & (w < b)  # noqa: E731  # most words need no pattern

    def parts(w: Column, e: Column) -> Column:
        small = starts(w, "a", "{")
        up = starts(w, "A", "[") | (~small & F.regexp_like(w, F.lit(r"^[^\p{L}\p{N}]*\p{Lu}")) & (w != F.lower(w)))
        bare = F.when(starts(e, "a", "{") | F.regexp_like(e, F.lit(r"[\p{L}\p{N}]")), e).otherwise("")
        return F.struct(
            w.alias("w"), e.alias("e"), bare.alias("bare"), up.alias("up"),
            (~small & ~starts(w, "A", "[") & _is_number(w)).alias("number"),
        )

    def of(known: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            before = F.get(known, i - 1)
            # a capital that doesn't begin the text or a sentence begins a name
            name = x["up"] & (i > 0) & ~F.substr(before["w"], F.lit(-1), F.lit(1)).isin(*SENTENCE_ENDS)
            template = (
                F.when(x["number"], NUMBER).when(name, NAME)
                .when((i > 0) & F.coalesce(before["number"], F.lit(False)) & F.array_contains(units, x["bare"]), UNIT)
                .otherwise(x["bare"])
            )
            return F.struct(
                template.alias("t"), F.when(x["number"], _trimmed(x["w"])).otherwise(x["e"]).alias("e"), x["bare"].alias("bare"), x["up"].alias("up")
            )

        return F.transform(known, one)

    return let(F.zip_with(words, split_words(_plain(words)), parts), of)


def word_codes(words: Column) -> list[Column]:
    """What the windows need of each word, as two arrays: ``e``, the hash of its plain word, and
    ``f``, flags. Both say what :func:`readings` says of it, without its strings."""
    starts = lambda w, a, b: (w >= a) & (w < b)
    small, capital, digit = (lambda w: starts(w, "a", "{")), (lambda w: starts(w, "A", "[")), (lambda w: starts(w, "0", ":"))

    def flags(w: Column) -> Column:
        ends = F.when(F.substr(w, F.lit(-1), F.lit(1)).isin(*SENTENCE_ENDS), ENDS).otherwise(0)
        other = (
            F.when(F.regexp_like(w, F.lit(r"[\p{L}\p{N}]")), BARE).otherwise(0)
            + F.when(F.regexp_like(w, F.lit(r"^[^\p{L}\p{N}]*\p{Lu}")) & (w != F.lower(w)), UP).otherwise(0)
            + F.when(_is_number(w), IS_NUMBER).otherwise(0)
        )
        kind = F.when(small(w), BARE).when(capital(w), BARE + UP).when(digit(w), BARE + IS_NUMBER).otherwise(other)
        return (kind + ends).cast("tinyint")

    def code(w: Column, e: Column) -> Column:
        return F.xxhash64(F.when(~small(w) & ~capital(w) & (digit(w) | _is_number(w)), _trimmed(w)).otherwise(e))

    return [F.zip_with(words, split_words(_plain(words)), code).alias("e"), F.transform(words, flags).alias("f")]


def combine(first: np.ndarray, rest: list[np.ndarray]) -> np.ndarray:
    """Hashes of windows from the hashes of their words, place by place."""
    h = first * _ODD
    for x in rest:
        h = (h + x) * _ODD
    h = h ^ (h >> np.uint64(32))
    h = (h + np.uint64(len(rest) + 1)) * _ODD
    return h ^ (h >> np.uint64(29))


@F.pandas_udf(LongType())
def _hash(words: pd.Series) -> pd.Series:
    """The hash of a window, given as an array of its words' hashes."""
    out = [combine(x[:1], [x[k : k + 1] for k in range(1, len(x))])[0] for x in (np.array(w, np.int64).view(np.uint64) for w in words)]
    return pd.Series(np.array(out, np.uint64).view(np.int64))


def template_codes(e: np.ndarray, f: np.ndarray, start: np.ndarray, fixed: dict) -> tuple[np.ndarray, np.ndarray]:
    """Of the words of several texts, which begin at ``start``: the hash of each one's template
    word, and whether it begins with a capital and is read as itself (``readings``)."""
    number, up = (f & IS_NUMBER) > 0, (f & UP) > 0
    follows = np.ones(len(e), bool)
    follows[start] = False
    before = np.concatenate((np.zeros(1, f.dtype), f[:-1]))
    name = up & follows & ((before & ENDS) == 0)
    t = np.where((f & BARE) > 0, e, fixed[""])
    after = np.flatnonzero(follows & ((before & IS_NUMBER) > 0))
    unit = np.zeros(len(e), bool)
    unit[after] = np.isin(t[after], fixed["units"])
    t = np.where(unit, fixed[UNIT], t)
    t = np.where(name, fixed[NAME], t)
    return np.where(number, fixed[NUMBER], t), up & ~name & ~unit & ~number


def window_hashes(e: np.ndarray, f: np.ndarray, sizes: np.ndarray, template: list[int], plain: list[int], fixed: dict):
    """Text and place of the first word, and hash, of all windows of several texts, whose words
    follow each other: windows of template words (with the first word also read as a name, if a
    capital begins it) and of plain words. One kind at a time."""
    if not len(e):
        return
    text = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    start = (ends - sizes)[sizes > 0]
    t, named = template_codes(e, f, start, fixed)
    room = ends[text] - np.arange(len(e))
    place = sizes[text] - room
    for words, length in [(t, n) for n in template] + [(e, n) for n in plain]:
        i = np.flatnonzero(room >= length)
        yield text[i], place[i], combine(words[i], [words[i + k] for k in range(1, length)])
        if words is t:
            i = i[named[i]]
            yield text[i], place[i], combine(np.full(len(i), fixed[NAME]), [t[i + k] for k in range(1, length)])


def _windows(template: list[int], plain: list[int], fixed: dict, seen: np.ndarray):
    """A function from batches (keys, ``e``, ``f``) to rows (keys, ``p``, ``h``) of the windows
    that ``seen``, a table of bits by hash, doesn't rule out."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e, f, keys = batch.column("e"), batch.column("f"), batch.select(["_rk", "_tk", "doc_id"])
            offsets = e.offsets.to_numpy().astype(np.int64)
            codes = e.values.to_numpy(zero_copy_only=False).view(np.uint64)
            bits = f.values.to_numpy(zero_copy_only=False)
            shift = int(f.offsets[0].as_py()) - int(offsets[0])
            at = 0
            while at < len(e):  # some texts at a time
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + WORDS_AT_ONCE, "right")) - 1)
                a, b = offsets[at], offsets[to]
                sizes = offsets[at + 1 : to + 1] - offsets[at:to]
                for text, place, h in window_hashes(codes[a:b], bits[a + shift : b + shift], sizes, template, plain, fixed):
                    slot = h & np.uint64(len(seen) * 64 - 1)
                    hit = (seen[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
                    if hit.any():
                        rows = keys.take(pa.array(text[hit] + at))
                        yield pa.RecordBatch.from_arrays(
                            [*rows.columns, pa.array(place[hit].astype(np.int32)), pa.array(h[hit].view(np.int64))],
                            names=["_rk", "_tk", "doc_id", "p", "h"],
                        )
                at = to

    return of


def hash_bits(hashes: DataFrame) -> np.ndarray:
    """A table of ``FILTER_BITS`` bits, in which that of every hash (``h``) is set."""
    slot = F.col("h").bitwiseAND(FILTER_BITS - 1)
    words = hashes.groupBy(F.shiftright(slot, 6).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("b"))
    seen = np.zeros(FILTER_BITS // 64, np.int64)
    for i, b in words.collect():  # at most FILTER_BITS / 64
        seen[i] = b
    return seen.view(np.uint64)


def fixed_codes(spark: SparkSession) -> dict:
    """Hashes of the placeholders, of the empty word and of the unit words."""
    words = [NUMBER, NAME, UNIT, "", *UNITS]
    row = spark.range(1).select(*[F.xxhash64(F.lit(w)).alias(f"c{i}") for i, w in enumerate(words)]).first()
    codes = np.array(list(row), np.int64).view(np.uint64)
    return {**dict(zip(words[:4], codes[:4], strict=True)), "units": codes[4:]}


def benchmark_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``h``, ``item_id``, ``at``, ``length``, ``plain``, ``n_words`` of the windows of every
    item. Template windows: an item shorter than ``window`` is one, and items of fewer than
    ``SHORT_ITEM`` words have windows of ``SHORT_WINDOW`` besides; the first word is read in
    every way that its context may make of it. Plain windows: of ``SHORT_WINDOW`` words, of
    ``LEAST_WINDOW`` in items of fewer than ``TINY_ITEM``, the whole of a shorter item."""
    words = items.select(items[item_id].alias("item_id"), split_words(text_of(items[text])).alias("w"))
    words = words.where(F.size("w") > 0)
    rows = words.select("item_id", F.size("w").alias("n_words"), readings(F.col("w")).alias("r"))
    slots = F.array(F.lit(NUMBER), F.lit(NAME), F.lit(UNIT), F.lit(""))
    n = F.col("n_words")

    def placed(some: DataFrame, length: int) -> DataFrame:
        return some.select("item_id", "n_words", F.explode(F.sequence(F.lit(0), n - length)).alias("at"), "r").select(
            "item_id", "n_words", "at", F.slice("r", F.col("at") + 1, length).alias("x")
        )

    columns = ["h", "item_id", "at", "length", "plain", "n_words"]
    out = []
    for length in sorted({*range(MIN_ITEM, window + 1), SHORT_WINDOW}):
        mine = (n >= length) if length == window else (n == length) & (n < window)
        if length == SHORT_WINDOW:
            mine = mine | n.between(max(length, MIN_ITEM), SHORT_ITEM - 1)
        x0 = F.get("x", F.lit(0))
        ways = F.array_distinct(F.array_compact(F.array(
            x0["t"], F.when(x0["t"].isin(NAME, UNIT), x0["bare"]), F.when(x0["up"] & (x0["t"] == x0["bare"]), NAME),
            F.when(x0["bare"].isin(*UNITS), UNIT),
        )))
        part = placed(rows.where(mine), length).select("*", F.explode(ways).alias("t0"))
        read = F.concat(F.array("t0"), F.transform(F.slice("x", 2, length), lambda r: r["t"]))
        part = part.withColumn("read", read)
        literal = length - F.size(F.filter("read", lambda t: F.array_contains(slots, t)))
        out.append(part.where(literal >= min(MIN_LITERAL, length)).select(
            _hash(F.transform("read", lambda t: F.xxhash64(t))).alias("h"),
            "item_id", "at", F.lit(length).alias("length"), F.lit(False).alias("plain"), "n_words",
        ))
    for length in sorted({*range(1, MIN_ITEM), LEAST_WINDOW, SHORT_WINDOW}):
        mine = n == length if length < MIN_ITEM else F.lit(False)
        if length == LEAST_WINDOW:
            mine = mine | n.between(MIN_ITEM, TINY_ITEM - 1)
        if length == SHORT_WINDOW:
            mine = mine | (n >= TINY_ITEM)
        out.append(placed(rows.where(mine), length).select(
            _hash(F.transform("x", lambda r: F.xxhash64(r["e"]))).alias("h"),
            "item_id", "at", F.lit(length).alias("length"), F.lit(True).alias("plain"), "n_words",
        ))
    both = out[0]
    for part in out[1:]:
        both = both.union(part)
    return both.select(*columns).distinct()


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
            item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``_rk``, ``_tk``, ``doc_id``, ``item_id``, ``shift``, ``at`` (of the item), ``length``,
    ``n_words``: every window of an item that stands in a document."""
    bench = pinned(benchmark_windows(items, item_id, item_text, window))
    kinds = [tuple(r) for r in bench.select("plain", "length").distinct().collect()]  # at most window + 5
    sides = broadcast_checked(bench.drop("plain").distinct())
    rk, tk = row_key(docs, doc_id, text)
    rows = docs.select(rk, tk, docs[doc_id].alias("doc_id"), split_words(text_of(docs[text])).alias("w"))
    template, plain = (sorted(n for p, n in kinds if p == side) for side in (False, True))
    rows = rows.select("_rk", "_tk", "doc_id", *word_codes(F.col("w")))
    doc_type = docs.schema[doc_id].dataType.simpleString()
    found = rows.mapInArrow(
        _windows(template, plain, fixed_codes(docs.sparkSession), hash_bits(bench)), f"_rk long, _tk long, doc_id {doc_type}, p int, h long"
    )
    return found.join(sides, "h").select(
        "_rk", "_tk", "doc_id", "item_id", (F.col("p") - F.col("at")).alias("shift"), "at", "length", "n_words"
    )


def _deviating(pairs: Column) -> Column:
    """How many of the slots (type ``t``, item value ``a``, document value ``b``) are outside
    a one-to-one mapping of values. Verbatim pairs are in it, then the most frequent ones."""
    same = lambda p, q: (p["t"] == q["t"]) & (p["a"] == q["a"]) & (p["b"] == q["b"])
    ranked = F.array_sort(
        F.transform(
            F.array_distinct(pairs),
            lambda p: F.struct(
                (p["a"] != p["b"]).alias("other"), (-F.size(F.filter(pairs, lambda q: same(p, q)))).alias("m"),
                F.concat(p["t"], p["a"]).alias("a"), F.concat(p["t"], p["b"]).alias("b"),
            ),
        )
    )
    none = F.array().cast("array<string>")

    def step(acc: Column, p: Column) -> Column:
        taken = F.array_contains(acc["a"], p["a"]) | F.array_contains(acc["b"], p["b"])
        return F.struct(
            F.when(taken, acc["a"]).otherwise(F.array_append(acc["a"], p["a"])).alias("a"),
            F.when(taken, acc["b"]).otherwise(F.array_append(acc["b"], p["b"])).alias("b"),
            F.when(taken, acc["n"] - p["m"]).otherwise(acc["n"]).alias("n"),
        )

    start = F.struct(none.alias("a"), none.alias("b"), F.lit(0).alias("n"))
    return F.when(F.forall(pairs, lambda p: p["a"] == p["b"]), 0).otherwise(F.aggregate(ranked, start, step, lambda a: a["n"]))


def _union(spans: Column) -> Column:
    """Words under sorted (at, length) spans."""
    step = lambda acc, x: F.struct(
        F.greatest(acc["end"], x["at"] + x["length"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), x["at"] + x["length"] - F.greatest(acc["end"], x["at"]))).alias("n"),
    )
    return F.aggregate(spans, F.struct(F.lit(-1_000_000).alias("end"), F.lit(0).alias("n")), step, lambda a: a["n"])


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", window: int = WINDOW, min_cover: float = MIN_COVER, min_run: int = MIN_RUN,
          band: int = BAND) -> DataFrame:
    """``_rk``, ``_tk``, ``doc_id``, ``item_id``, ``start`` (word of the document where the
    item begins), ``covered`` and ``n_words`` (words of the item), ``n_slots`` under the
    windows. One place may be reported with two starts that differ by ``band`` at most."""
    found = matches(docs, items, doc_id, text, window, item_id, item_text)
    keys = ["_rk", "_tk", "doc_id", "item_id", "n_words"]
    lined = found.groupBy(*keys, "shift").agg(F.array_sort(F.collect_set(F.struct("at", "length"))).alias("hits"))
    # zones of alignments: any two that differ by the band at most share one
    zones = [(F.floor((F.col("shift") + k * band) / (2 * band)) * 2 + k).alias("zone") for k in (0, 1)]
    lined = lined.select("*", F.explode(F.array(*zones)).alias("zone")).groupBy(*keys, "zone").agg(
        F.array_sort(F.collect_list(F.struct((-F.size("hits")).alias("w"), "shift", "hits"))).alias("lines")
    )
    # every hit, those of the alignment with most of them first
    hits = F.flatten(F.transform("lines", lambda x: F.transform(x["hits"], lambda y: F.struct(y["at"].alias("at"), y["length"].alias("length"), x["shift"].alias("shift")))))
    lined = lined.withColumn("hits", hits).drop("lines")
    in_item = F.array_sort(F.transform("hits", lambda x: F.struct(x["at"].alias("at"), x["length"].alias("length"))))
    in_doc = F.array_sort(F.transform("hits", lambda x: F.struct((x["at"] + x["shift"]).alias("at"), x["length"].alias("length"))))
    # words of the item under the windows: at most as many as the item has
    lined = lined.withColumn("covered", F.least(_union(in_item), _union(in_doc))).where(
        (F.col("covered") >= F.col("n_words") * min_cover) | (F.col("covered") >= min_run)
    )
    first = F.array_min(F.transform("hits", lambda x, i: F.struct(x["at"].alias("at"), i.alias("i"), x["shift"].alias("shift"))))
    lined = pinned(lined.withColumn("shift", first["shift"]).drop("zone").distinct())
    # slots: the item's placeholder words under the windows against the document's words there
    w = items.select(items[item_id].alias("item_id"), split_words(text_of(items[item_text])).alias("iw"))
    w = w.withColumn("it", readings(F.col("iw")))
    # words that begin with a capital are names in some contexts
    slots = F.filter(
        F.transform("it", lambda r, i: F.struct(
            i.alias("i"), F.when(r["up"] & ~r["t"].isin(NUMBER, UNIT), NAME).otherwise(r["t"]).alias("t"), F.lower(F.get("iw", i)).alias("a")
        )),
        lambda s: s["t"].isin(NUMBER, NAME, UNIT),
    )
    w = w.select("item_id", slots.alias("slots"))
    some = lined.join(broadcast_checked(w), "item_id")
    # the alignments on which a slot stands under a window
    over = lambda s: F.array_distinct(F.transform(
        F.filter("hits", lambda x: (x["at"] <= s["i"]) & (s["i"] < x["at"] + x["length"])), lambda x: x["shift"]
    ))
    at = F.transform("slots", lambda s: F.struct(s["i"].alias("i"), s["t"].alias("t"), s["a"].alias("a"), over(s).alias("over")))
    some = some.withColumn("slots", F.filter(at, lambda s: F.size(s["over"]) > 0))
    plain = some.where("size(slots) = 0").select(*lined.columns, F.lit(0).alias("n_slots"))
    slotted = pinned(some.where("size(slots) > 0"))
    rk, tk = row_key(docs, doc_id, text)
    texts = docs.select(rk, tk, split_words(text_of(docs[text])).alias("w"))
    wanted = broadcast_checked(slotted.select("_rk", "_tk").distinct())
    texts = texts.join(wanted, ["_rk", "_tk"], "left_semi").dropDuplicates(["_rk", "_tk"])
    bare = lambda x: F.regexp_replace(F.lower(x), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    values = lambda s: F.transform(s["over"], lambda d: F.coalesce(bare(F.get("w", s["i"] + d)), F.lit("")))
    read = F.transform("slots", lambda s: F.struct(s["t"].alias("t"), bare(s["a"]).alias("a"), values(s).alias("b")))
    pairs = F.transform(
        read,
        lambda s: F.struct(
            s["t"].alias("t"), s["a"].alias("a"), F.when(F.array_contains(s["b"], s["a"]), s["a"]).otherwise(s["b"][0]).alias("b")
        ),
    )
    checked = slotted.join(texts, ["_rk", "_tk"]).withColumn("dev", let(pairs, _deviating)).where(
        ((F.col("dev") == 0) & (F.col("covered") >= F.col("n_words") * min_cover))
        | ((F.col("covered") - F.col("dev") >= min_run) & (F.col("dev") <= F.greatest(F.lit(1), F.size("slots") * MAX_DEVIATING)))
    )
    both = plain.union(checked.select(*lined.columns, F.size("slots").alias("n_slots")))
    return both.select("_rk", "_tk", "doc_id", "item_id", F.col("shift").alias("start"), "covered", "n_words", "n_slots")


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document and leaked item: the best alignment."""
    found = leaks(docs, items, **options)
    best = F.max(F.struct("covered", (-F.col("start")).alias("s"), "n_words", "n_slots"))
    band = options.get("band", BAND)
    step = lambda acc, x: F.struct(
        F.when(x > acc["end"] + band, x).otherwise(acc["end"]).alias("end"),
        (acc["n"] + (x > acc["end"] + band).cast("long")).alias("n"),
    )
    apart = F.aggregate("starts", F.struct(F.lit(-1_000_000).alias("end"), F.lit(0).cast("long").alias("n")), step, lambda a: a["n"])
    rows = found.groupBy("doc_id", "item_id").agg(best.alias("b"), F.array_sort(F.collect_set("start")).alias("starts"))
    return rows.select(
        "doc_id", "item_id", (-F.col("b.s")).cast("long").alias("start_word"), F.col("b.covered").cast("long").alias("covered_words"),
        F.col("b.n_words").cast("long").alias("item_words"), F.col("b.n_slots").cast("long").alias("n_slots"), apart.alias("n_places"),
    )


def remove_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without a leaked item, all columns unchanged."""
    gone = leaks(docs, items, doc_id, text, **options).select("_rk", "_tk").distinct()
    return without_rows(docs, gone, doc_id, text)
