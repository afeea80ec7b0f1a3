"""Exact token counts at every prefix, for a word-level BPE vocabulary.

The encoding of a string under BPE merges extends the encoding of each of its token
prefixes, so the last token of every prefix follows from those of shorter ones: among the
vocabulary's suffixes of the prefix it is the one that the merges leave standing next to the
last token before it. One pass over a word therefore gives the token count of all its
prefixes (twice: as the inside of a word, and closed by the word-end mark). Counts of words
add up over a text, since words never merge, and a table of word counts with a table per
word answers "how many tokens has the text up to here" and "where must it be cut to fit"
without encoding again.

The vocabulary is read from a ``tokenizers`` file whose normaliser composes, folds white
space and lower-cases, and whose words are contractions, runs of letters, single digits and
runs of other characters. The counts are the ones that library gives; tests compare them.

Defined results: null is the empty text with 0 tokens; special strings inside a text are one
token each, as is the library's default; texts of any length are read whole; repeated rows
give repeated results; an empty table gives no rows. Extra columns are not used.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
from collections.abc import Callable, Iterator
from itertools import accumulate
from types import ModuleType

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import ship

ship(__name__)

LIMIT = 2048
CACHE = 500_000  # chunks, and words, whose count a worker remembers; then it starts anew

# The vocabulary's word pattern and its white space.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
END = "</w>"


_CONTROLS = regex.compile("[\x1c-\x1f]")


class PrefixCounter:
    """Prefix token counts under one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.rank = {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): i for i, m in enumerate(model["merges"])}
        self.inside = {t for t in model["vocab"] if not t.endswith(END)}
        self.closing = {t[: -len(END)] for t in model["vocab"] if t.endswith(END)}
        self.longest = max(map(len, self.inside | self.closing))
        self.word = regex.compile(rf"{'|'.join(CONTRACTIONS)}|[\p{{L}}]+|[\p{{N}}]|[^{SPACES}\p{{L}}\p{{N}}]+")
        self.space = regex.compile(f"[{SPACES}]+")
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        # the printable characters that stand for bytes
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        self.byte = [chr(b) if b in set(shown) else chr(next(other)) for b in range(256)]
        self.splits: dict[str, tuple[str, str, int] | None] = {}
        self.stands: dict[tuple[str, str], bool] = {}
        self.totals: dict[str, int] = _Remembered(self.chunk_total)
        self.words: dict[str, int] = _Remembered(self.total)
        self._data, self._last, self._count = "", [0], [0]

    def merged(self, symbols: list[str]) -> tuple[list[str], tuple[str, str, int] | None]:
        """The merges applied in the order of their rank, leftmost first, and the last one."""
        last = None
        while len(symbols) > 1:
            pairs = list(zip(symbols, symbols[1:]))
            least, pair = min((self.rank.get(p, 1 << 60), p) for p in pairs)
            if least == 1 << 60:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols, last = out, (*pair, least)
        return symbols, last

    def split(self, token: str) -> tuple[str, str, int] | None:
        """The merge that makes a token: left, right, rank. A single symbol has rank -1, a
        token that the merges don't make of its symbols has none."""
        if token in self.splits:
            return self.splits[token]
        bare = token.removesuffix(END)
        symbols = list(bare)
        if token != bare:
            symbols[-1] += END
        if len(symbols) == 1:
            found = ("", "", -1)
        else:
            left, last = self.merged(symbols)
            found = last if len(left) == 1 else None
        self.splits[token] = found
        return found

    def fits(self, before: str, token: str) -> bool:
        """Whether the merges leave ``before`` and ``token`` (or, with no ``before``, the token
        alone) standing side by side. Seen backwards: undo the later of the two tokens' last
        merges, again and again; had a merge over the border come before it, it would have
        been made. Of equal ranks the left one comes first."""
        if not before:
            return self.split(token) is not None
        key = (before, token)
        known = self.stands.get(key)
        if known is not None:
            return known
        if len(self.stands) > 2_000_000:
            self.stands.clear()
        rank, a, b = self.rank, before, token
        x, y = self.split(a), self.split(b)
        good = x is not None and y is not None and (a, b) not in rank
        while good and (x[2] >= 0 or y[2] >= 0):
            if x[2] > y[2]:
                limit, a = x[2], x[1]
                x = self.split(a)
                good = rank.get((a, b), 1 << 60) >= limit
            else:
                limit, b = y[2], y[0]
                y = self.split(b)
                good = rank.get((a, b), 1 << 60) > limit
        self.stands[key] = good
        return good

    def data(self, piece: str) -> str:
        """A word as the characters that stand for its bytes."""
        if piece.isascii() and piece.isprintable():
            return piece
        return "".join([self.byte[b] for b in piece.encode()])

    def inner(self, data: str) -> tuple[list[int], list[int]]:
        """Length of the last token, and number of tokens, of each prefix inside a word. What
        the word before shares with this one is kept."""
        k, most = 0, min(len(data), len(self._data))
        old, last, count = self._data, self._last, self._count
        while k < most and data[k] == old[k]:
            k += 1
        del last[k + 1 :], count[k + 1 :]
        inside, fits, longest = self.inside, self.fits, self.longest
        for j in range(k + 1, len(data) + 1):
            for i in range(max(0, j - longest), j):
                token = data[i:j]
                if token in inside and fits(data[i - last[i] : i], token):
                    last.append(j - i)
                    count.append(count[i] + 1)
                    break
        self._data = data
        return last, count

    def closed(self, data: str, j: int, last: list[int], count: list[int]) -> int:
        """Tokens of the first ``j`` symbols closed as a word."""
        for i in range(max(0, j - self.longest), j):
            token = data[i:j]
            if token in self.closing and self.fits(data[i - last[i] : i], token + END):
                return count[i] + 1
        raise ValueError(f"no token closes {data[:j]!r}")

    def total(self, piece: str) -> int:
        """Tokens of one word of the pattern."""
        data = self.data(piece)
        if data in self.closing and self.split(data + END):
            return 1
        last, count = self.inner(data)
        return self.closed(data, len(data), last, count)

    def piece(self, piece: str) -> list[int]:
        """Token counts of all prefixes, each closed as a word, of one word of the pattern."""
        data = self.data(piece)
        last, count = self.inner(data)
        ends = range(1, len(data) + 1) if len(data) == len(piece) else accumulate(len(c.encode()) for c in piece)
        return [self.closed(data, j, last, count) for j in ends]

    def normal(self, chunk: str) -> str:
        chunk = unicodedata.normalize("NFC", chunk)
        # letter by letter: Python's own rule for a final sigma depends on what follows
        return chunk.lower() if chunk.isascii() or "Σ" not in chunk else "".join(c.lower() for c in chunk)

    def plain(self, chunk: str) -> list[int]:
        """Counts of all prefixes of a chunk without white space or special strings."""
        text = self.normal(chunk)
        if len(text) != len(chunk) or not (chunk.isascii() or unicodedata.is_normalized("NFC", chunk)):
            return self._composed(chunk)
        out, base = [], 0
        for m in self.word.finditer(text):
            word = m.group()
            counts = self.piece(word)
            if word in CONTRACTIONS:  # cut short it is an apostrophe and a letter
                tick = self.total("'")
                counts = [tick, *[tick + self.total(word[1:k]) for k in range(2, len(word))], counts[-1]]
            out += [base + c for c in counts]
            base = out[-1]
        return out

    def _composed(self, chunk: str) -> list[int]:
        """The same where composing or lower-casing changes the number of characters: every
        prefix is normalised by itself, from the last place that nothing after it can change
        (between two ASCII characters where a word ends)."""
        out, start, base = [], 0, 0
        kind = lambda c: "l" if c.isalpha() else "d" if c.isdigit() else "s"
        for j in range(1, len(chunk) + 1):
            words = self.word.findall(self.normal(chunk[start:j]))
            out.append(base + sum(self.total(w) for w in words))
            if j < len(chunk) and chunk[j - 1 : j + 1].isascii() and "'" not in chunk[max(0, j - 3) : j + 1]:
                if kind(chunk[j - 1]) != kind(chunk[j]):
                    start, base = j, out[-1]
        return out

    def chunk(self, chunk: str) -> list[int]:
        """Counts of all prefixes of a chunk without white space."""
        if self.special is None or "<|" not in chunk:
            return self.plain(chunk)
        out, base, text = [], 0, ""
        for part in self.special.split(chunk):
            if part in self.specials:
                # cut short, the special string is ordinary text after what precedes it
                counts = self.plain(text + part)
                whole = self.chunk_total(text)
                out += [base + c for c in counts[:-1]] + [base + whole + 1]
                base, text = out[-1], ""
            else:
                text = part
        return out + ([base + c for c in self.plain(text)] if text else [])

    def chunk_total(self, chunk: str) -> int:
        """The last of the counts of :meth:`chunk`, from one pass per word not seen before."""
        words = self.words
        if self.special is None or "<|" not in chunk:
            return sum([words[w] for w in self.word.findall(self.normal(chunk))])
        return sum(
            1 if p in self.specials else sum([words[w] for w in self.word.findall(self.normal(p))])
            for p in self.special.split(chunk)
        )

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text. Chunks not seen before are worked out in sorted order, so that
        each starts from the prefix that it shares with the one before."""
        totals = self.totals
        # str.split() also splits at four control characters that are no white space here
        chunks = [self.space.split(t) if _CONTROLS.search(t) else t.split() for t in texts]
        new = set().union(*chunks)
        for c in sorted(new.difference(totals)):
            totals[c]
        return [sum([totals[c] for c in cs]) for cs in chunks]

    def count(self, text: str) -> int:
        return self.counts([text])[0]

    def prefixes(self, text: str) -> np.ndarray:
        """Token count of every prefix, by code points, from the empty one to the whole text."""
        out, base, at = np.zeros(len(text) + 1, np.int64), 0, 0
        for m in self.space.splititer(text):
            if m:
                at = text.index(m, at)
                counts = self.chunk(m)
                out[at + 1 : at + len(m) + 1] = np.asarray(counts) + base
                base, at = base + counts[-1], at + len(m)
                out[at:] = base
        return out

    def cut(self, text: str, limit: int) -> int:
        """Code points of the longest prefix with at most ``limit`` tokens; white space after
        the last word that fits belongs to it."""
        base, at = 0, 0
        for m in self.space.splititer(text):
            if not m:
                continue
            place = text.index(m, at)
            if base + self.totals[m] > limit:
                fit = [k for k, c in enumerate(self.chunk(m), 1) if base + c <= limit]
                return place + (fit[-1] if fit else 0)
            base, at = base + self.totals[m], place + len(m)
        return len(text)


class _Remembered(dict):
    """A token count per string, the last entry of its prefix counts, worked out when first seen."""

    def __init__(self, work: Callable[[str], int]):
        super().__init__()
        self.work = work

    def __missing__(self, text: str) -> int:
        n = self.work(text)
        if len(self) >= CACHE:
            self.clear()
        self[text] = n
        return n


def counter(name: str) -> PrefixCounter:
    """The counter of a vocabulary file of ``public_tokenizers``, or of a path. It stays with
    the process, so a worker's later tasks find the words of its earlier ones."""
    import public_tokenizers

    known = vars(sys.modules.setdefault("_prefix_counters", ModuleType("_prefix_counters")))
    if name not in known:
        known[name] = PrefixCounter(name if os.path.isabs(name) else public_tokenizers.path(name))
    return known[name]


VOCABULARY = "word_bpe_49k.json"


def token_counts(docs: DataFrame, limit: int = LIMIT, vocabulary: str = VOCABULARY, with_prefixes: bool = False,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` and ``cut_chars``, the code points
    of the longest prefix within ``limit``; on request ``prefixes``, the count at every one."""
    # ids travel as text: pandas would turn whole numbers with nulls into doubles
    rows = docs.select(docs[doc_id].cast("string").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    id_type = docs.schema[doc_id].dataType
    schema = "doc_id string, n_bytes long, n_tokens long, over_limit boolean, cut_chars long"
    schema += ", prefixes array<long>" * with_prefixes

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(vocabulary)
        for frame in frames:
            texts = frame["text"].tolist()
            out = frame.drop(columns="text")
            out["n_tokens"] = n = np.array(c.counts(texts), np.int64)
            out["over_limit"] = n > limit
            out["cut_chars"] = [c.cut(t, limit) if k > limit else len(t) for t, k in zip(texts, n)]
            if with_prefixes:
                out["prefixes"] = [c.prefixes(t) for t in texts]
            yield out

    return rows.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast(id_type))


def report(docs: DataFrame, **options) -> DataFrame:
    return token_counts(docs, **options)
