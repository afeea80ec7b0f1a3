"""Alignment of two tokenizers' encodings of the same texts, by interval coalescing.

Both encodings of a text are tilings of its bytes by intervals. All intervals of A and B, of
a batch of texts one after another on one axis, are sorted by start; a running maximum of the
ends is kept, and a group ends where the next start reaches it. Inside a group the tokens
overlap; at its end a token of A and one of B end together, and are linked. How often two
entries of the vocabularies are linked in the whole corpus says which entry of A an entry of B
stands for.

Texts are tokenised and grouped once; what later steps need is written to the shared folder,
with the distinct links of a text and how often it has each. Spark adds these up by link. The
counts then go back to the texts: the ``HOT_LINKS`` most frequent at most are broadcast, by a
cut in their frequency, so what is left for the shuffled join has no frequent key.

A is a byte-level BPE vocabulary: its file is read, and its merges, if ranked by id as they
are, are applied by ``tiktoken``; texts with very long runs without a border between words go
to ``tokenizers``, which needs less time for them. B is a sentencepiece model, which puts a
space before a text. Strings of special tokens are plain text in both.

Defined results: texts that are null or empty, or whose tokens do not give their bytes back in
both vocabularies (B folds U+2581 into a space, and bytes that are not UTF-8 are read by
neither), have no tokens, zeros and an empty digest; texts of any length are read whole;
repeated rows are counted each; a null id stays; an empty table gives no rows. Only the id and
text columns are used, so other columns, of any name, don't matter.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
from collections.abc import Iterator
from functools import partial
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import ship
from tillroll.operators.joins import pinned

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
HOT_LINKS = 1_000_000
CHARS = 1_000_000  # texts are worked on together up to so many characters
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")

ship(__name__)


class Vocabularies:
    """The two tokenizers, and the bytes that their entries stand for."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        # the printable characters that stand for bytes
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        vocab = spec["model"]["vocab"]
        special = {t["id"]: t["content"] for t in spec["added_tokens"]}
        plain = {i: bytes(byte[c] for c in t) for t, i in vocab.items() if i not in special}
        self.a_bytes = [plain.get(i, special.get(i, "").encode()) for i in range(max([*plain, *special]) + 1)]
        self.library = Tokenizer.from_file(a_path)
        self.library.encode_special_tokens = True
        joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
        ranked = [vocab[t] for t in joined]
        self.fast = None
        if ranked == sorted(ranked):  # tiktoken merges by id, which is then the order of the merges
            self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={b: i for i, b in plain.items()}, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        ids = range(self.pieces.get_piece_size())
        piece = self.pieces.id_to_piece
        self.b_bytes = [
            bytes([int(piece(i)[1:-1], 16)]) if self.pieces.is_byte(i) else piece(i).replace("▁", " ").encode() for i in ids
        ]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # what is written after an entry: , inside a side, | after A's side, ; after a group
        n, m = len(self.a_bytes), len(self.b_bytes)
        self.written = [f"{i}{s}" for s in ",|" for i in range(n)] + [f"{i}{s}" for s in (",", ";", "") for i in range(m)]

    def encode_a(self, text: str) -> np.ndarray:
        if self.fast is None or (len(text) >= 2000 and LONG_RUN.search(text)):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)

    def encode_b(self, text: str) -> list[int]:
        return self.pieces.encode(text, num_threads=1)

    def encode(self, raw: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of both sides; none unless both give the bytes back."""
        none = np.zeros(0, np.int64)
        if not raw:
            return none, none
        text, whole = raw.decode("utf-8", "replace"), b" " + raw
        b = self.encode_b(text)
        if b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return none, none
        # the text is UTF-8, then; A's entries tile whatever bytes they are given
        a = self.encode_a(" " + text)
        return (a, np.array(b, np.int64)) if self.a_size[a].sum() == len(whole) else (none, none)


def vocabularies(a_name: str, b_name: str) -> Vocabularies:
    """The vocabularies of two files of ``public_tokenizers``, or paths. They stay with the
    process, for a worker's later tasks."""
    import public_tokenizers

    known = vars(sys.modules.setdefault("_aligned_vocabularies", ModuleType("_aligned_vocabularies")))
    key = f"{a_name} {b_name}"
    if key not in known:
        known[key] = Vocabularies(*[n if os.path.isabs(n) else public_tokenizers.path(n) for n in (a_name, b_name)])
    return known[key]


def coalesce(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, from the ends of two tilings of one axis."""
    ends = np.concatenate((a_end, b_end))
    starts = np.concatenate(([0], a_end[:-1], [0], b_end[:-1])) if len(ends) else ends
    order = np.lexsort((starts,))
    reached = np.maximum.accumulate(ends[order])
    opens = np.concatenate(([False], starts[order][1:] >= reached[:-1])) if len(ends) else np.zeros(0, bool)
    group = np.empty(len(ends), np.int64)
    group[order] = np.cumsum(opens)
    return group[: len(a_end)], group[len(a_end) :]


def align(v: Vocabularies, raws: list[bytes | None]) -> dict[str, np.ndarray | list]:
    """Per text the numbers of tokens, groups and links, the groups' digest, and its distinct
    links (A's id in the high half) with their number."""
    encoded = [v.encode(r) for r in raws]
    n_a, n_b = (np.array([len(e[i]) for e in encoded], np.int64) for i in (0, 1))
    a, b = (np.concatenate([e[i] for e in encoded]) for i in (0, 1))
    ga, gb = coalesce(np.cumsum(v.a_size[a]), np.cumsum(v.b_size[b]))
    groups = int(ga[-1]) + 1 if len(ga) else 0
    a_stop = np.searchsorted(ga, np.arange(groups), "right")  # tokens up to a group's end
    b_stop = np.searchsorted(gb, np.arange(groups), "right")
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    text_of_group = np.searchsorted(np.cumsum(n_a), a_stop - 1, "right")
    n_groups = np.bincount(text_of_group, minlength=len(raws)).astype(np.int64)
    # A's tokens of a group stand before B's; each with the sign that follows it
    signs, out = len(v.a_bytes), np.empty(len(a) + len(b), np.int64)
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), np.int64)
    last_a[a_stop - 1] = True
    last_b[b_stop - 1] = 1
    ends_text = n_b > 0
    last_b[(first_b + n_b - 1)[ends_text]] = 2
    before = np.concatenate(([0], b_stop))
    out[np.arange(len(a)) + before[ga]] = a + signs * last_a
    out[np.arange(len(b)) + a_stop[gb]] = b + 2 * signs + len(v.b_bytes) * last_b
    written = list(map(v.written.__getitem__, out.tolist()))
    cuts = (first_a + first_b).tolist()
    digests = [
        hashlib.sha256("".join(written[c : c + n]).encode()).hexdigest() if n else ""
        for c, n in zip(cuts, (n_a + n_b).tolist())
    ]
    link = (a[a_stop - 1] << 32) | b[b_stop - 1]
    order = np.lexsort((link, text_of_group))
    of, link = text_of_group[order], link[order]
    new = np.concatenate(([True], (of[1:] != of[:-1]) | (link[1:] != link[:-1]))) if groups else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": n_groups,
        "n_links": n_groups,  # one at the end of each group
        "groups_sha256": digests,
        "links": link[at],
        "times": np.diff(np.append(at, groups)),
        "bounds": np.concatenate(([0], np.cumsum(np.bincount(of[at], minlength=len(raws))))),
    }


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _aligned(batches: Iterator[pa.RecordBatch], names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    v = vocabularies(*names)
    for batch in batches:
        ids, raws = batch.column("doc_id"), batch.column("text").to_pylist()
        a = 0
        while a < len(raws):
            b, size = a, 0
            while b < len(raws) and (b == a or size + len(raws[b] or b"") <= CHARS):
                size += len(raws[b] or b"")
                b += 1
            found = align(v, raws[a:b])
            bounds = pa.array(found["bounds"], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), *[pa.array(found[k]) for k in NUMBERS], pa.array(found["groups_sha256"], pa.string())]
                + [pa.ListArray.from_arrays(bounds, pa.array(found[k])) for k in ("links", "times")],
                names=["doc_id", *NUMBERS, "groups_sha256", "links", "times"],
            )
            a = b


def alignments(docs: DataFrame, a_name: str = A_FILE, b_name: str = B_FILE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, numbered by ``_row``, with its distinct ``links`` and how many
    ``times`` it has each; written to the shared folder."""
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("binary").alias("text"))
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in NUMBERS)
    found = rows.mapInArrow(partial(_aligned, names=(a_name, b_name)), schema + ", groups_sha256 string, links array<long>, times array<long>")
    return pinned(found.withColumn("_row", F.monotonically_increasing_id()))


def link_counts(aligned: DataFrame) -> DataFrame:
    """``link``, its ``count`` in the corpus, and whether it is the ``best`` of its entry of B
    (ties included). The counts of B's entries are as few as its vocabulary."""
    each = aligned.select(F.explode(F.arrays_zip("links", "times")).alias("x"))
    counts = each.groupBy(F.col("x.links").alias("link")).agg(F.sum("x.times").alias("count"))
    counts = pinned(counts.withColumn("b", F.col("link").bitwiseAND((1 << 32) - 1)))
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    return pinned(counts.join(F.broadcast(top), "b").select("link", "count", (F.col("count") == F.col("top")).alias("best")))


def frequent_from(counts: DataFrame, most: int) -> int:
    """The least power of two that at most ``most`` links reach with their count."""
    # counts are longs, so there are at most 63 rows
    size = {r["p"]: r["n"] for r in counts.groupBy((F.length(F.bin("count")) - 1).alias("p")).agg(F.count("*").alias("n")).collect()}
    total, cut = 0, 63
    for p in range(62, -1, -1):
        total += size.get(p, 0)
        if total > most:
            break
        cut = p
    return 1 << cut


def rated(aligned: DataFrame, counts: DataFrame, hot_links: int = HOT_LINKS) -> DataFrame:
    """``_row``, ``n_best`` and ``count_sum`` of the documents that have links."""
    cut = frequent_from(counts, hot_links)
    each = aligned.select("_row", F.explode(F.arrays_zip("links", "times")).alias("x"))
    each = each.select("_row", F.col("x.links").alias("link"), F.col("x.times").alias("times"))
    hot = F.broadcast(counts.where(F.col("count") >= cut))

    def summed(of: DataFrame) -> DataFrame:
        best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0))
        return of.groupBy("_row").agg(best.alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))

    parts = summed(each.join(hot, "link"))
    if cut > 1:  # there are rarer ones; none of them has as many rows as the cut
        rare = each.join(hot.select("link"), "link", "left_anti").join(counts.where(F.col("count") < cut).hint("merge"), "link")
        parts = parts.union(summed(rare)).groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return parts


def report(docs: DataFrame, hot_links: int = HOT_LINKS, **options) -> DataFrame:
    aligned = alignments(docs, **options)
    sums = rated(aligned, link_counts(aligned), hot_links)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return aligned.join(sums, "_row", "left").select("doc_id", *NUMBERS, zero("n_best"), zero("count_sum"), "groups_sha256")
