"""Language identification by string kernels.

The kernel of two texts is the number of character n-grams (n = 1, 2, 3; letters lower-cased,
all else one blank) that are present in both, over the geometric mean of the numbers present
in each. Landmark texts give a Nyström approximation of its feature space, in which one ridge
regression per language separates it from the rest. A batch of texts becomes a presence
matrix; two matrix products give all scores.

n-grams are hashed to ``DIM`` columns. The fit uses a bounded sample of labelled rows: about
``per_lang`` documents of each language, chosen by the hash of their id; what is collected is
their packed presence rows, DIM / 8 bytes each, not their texts.

Defined results: a null text or one without a letter is ``und`` with score 0; without labelled
rows all is ``und``; ties go to the language that sorts first; texts of any length are read
whole, in pieces; repeated rows give repeated results; an empty table gives no rows. Extra
columns are not used.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import broadcast_checked, ship

ship(__name__)

DIM = 8192
ORDERS = (1, 2, 3)
PER_LANG = 400
LANDMARKS = 256
RIDGE = 1e-3
PIECE = 1_000_000  # characters handled at once
UNKNOWN = "und"
LETTER = r"\p{L}"


def _folding() -> np.ndarray:
    """Per code point of the basic plane: the lower-case letter, or a blank."""
    table = np.full(0x10000, 32, np.uint32)
    for i in range(0x10000):
        c = chr(i)
        if unicodedata.category(c)[0] in "LM":
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


_FOLD: list[np.ndarray] = []


def _columns(codes: np.ndarray, n: int) -> np.ndarray:
    """Hashed column of each n-gram of an array of code points."""
    m = len(codes) - n + 1
    h = np.full(m, np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF), np.uint32)
    for i in range(n):
        h = (h ^ codes[i : i + m]) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return (h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - DIM.bit_length() + 1)


def presence(texts: list[str]) -> np.ndarray:
    """A row per text: 1 where one of its n-grams falls on the column."""
    if not _FOLD:
        _FOLD.append(_folding())
    out = np.zeros((len(texts), DIM), np.float32)
    overlap = max(ORDERS) - 1
    for row, text in zip(out, texts):
        for at in range(0, max(len(text), 1), PIECE):
            piece = text[max(0, at - overlap) : at + PIECE]
            raw = np.frombuffer(f" {piece} ".encode("utf-32-le", "replace"), np.uint32)
            codes = np.where(raw < 0x10000, _FOLD[0][np.minimum(raw, 0xFFFF)], raw)
            blank = codes == 32
            codes = codes[~(blank & np.concatenate(([False], blank[:-1])))]
            for n in ORDERS:
                if len(codes) >= n:
                    row[_columns(codes, n)] = 1
    return out


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Normalised common presence of all rows of ``a`` with all of ``b``."""
    norm = np.sqrt(np.maximum(a.sum(axis=1), 1))[:, None] * np.sqrt(np.maximum(b.sum(axis=1), 1))[None, :]
    return (a @ b.T) / norm


@dataclass
class Model:
    """Landmarks (packed bits), and the weights of each language on the kernel with them."""

    langs: list[str]
    landmarks: np.ndarray
    weights: np.ndarray
    bias: np.ndarray


def fit(rows: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nyström features from evenly chosen rows per language, then one ridge regression per
    language against the rest (targets 1 and -1)."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros((0, DIM // 8), np.uint8), np.zeros((0, 0), np.float32), np.zeros(0, np.float32))
    label = np.array([names.index(x) for x in langs])
    each = max(1, landmarks // len(names))
    chosen = np.concatenate([np.flatnonzero(label == k)[:each] for k in range(len(names))])
    marks = rows[chosen]
    values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    good = values > 1e-8 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])  # inverse square root of the landmark kernel
    phi = kernel(rows, marks).astype(np.float64) @ root
    y = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    # every language weighs the same, however many rows it has
    weight = (1.0 / np.bincount(label, minlength=len(names)))[label][:, None]
    weight = weight / weight.sum()
    mean, level = (phi * weight).sum(axis=0), (y * weight).sum(axis=0)
    centred = phi - mean
    gram = centred.T @ (centred * weight) + ridge * np.eye(phi.shape[1])
    w = np.linalg.solve(gram, centred.T @ ((y - level) * weight))
    return Model(names, np.packbits(marks.astype(bool), axis=1), (root @ w).astype(np.float32), (level - mean @ w).astype(np.float32))


def predict(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and score (0 to 1, a softmax over the margins) of texts with letters."""
    if not model.langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    marks = np.unpackbits(model.landmarks, axis=1).astype(np.float32)
    names, scores = [], []
    for at in range(0, len(texts), 256):
        margin = kernel(presence(texts[at : at + 256]), marks) @ model.weights + model.bias
        best = margin.argmax(axis=1)
        share = np.exp(4 * (margin - margin.max(axis=1, keepdims=True)))
        names += [model.langs[b] for b in best]
        scores.append((share.max(axis=1) / share.sum(axis=1)).astype(np.float64))
    return names, np.concatenate(scores) if scores else np.zeros(0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(labelled: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """About ``per_lang`` rows of each ``lang`` of ``id``, ``lang``, ``text``: those whose hash
    falls under the share that this number is of the language's rows. No language is
    gathered in one task."""
    some = labelled.where(F.col("lang").isNotNull() & F.regexp_like(F.coalesce("text", F.lit("")), F.lit(LETTER)))
    n = broadcast_checked(some.groupBy("lang").agg(F.count("*").alias("n")))
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return some.join(n, "lang").where(draw < per_lang / F.col("n")).select(F.col("id").cast("string").alias("id"), "lang", "text")


def train(labelled: DataFrame, per_lang: int = PER_LANG, **options) -> Model:
    """A model from ``id``, ``lang`` and ``text``."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = np.packbits(presence(frame["text"].tolist()).astype(bool), axis=1)
            yield pd.DataFrame({"id": frame["id"], "lang": frame["lang"], "bits": [r.tobytes() for r in rows]})

    got = sample(labelled, per_lang).mapInPandas(pack, "id string, lang string, bits binary").collect()
    got = sorted((r["lang"], r["id"] or "", bytes(r["bits"])) for r in got)
    bits = np.frombuffer(b"".join(r[2] for r in got), np.uint8).reshape(len(got), DIM // 8)
    return fit(np.unpackbits(bits, axis=1).astype(np.float32), [r[0] for r in got], **options)


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of every document."""
    # ids travel as text: pandas would turn whole numbers with nulls into doubles
    rows = docs.select(docs[doc_id].cast("string").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    rows = rows.withColumn("lettered", F.regexp_like("text", F.lit(LETTER)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = pd.DataFrame({"doc_id": frame["doc_id"], "lang_pred": UNKNOWN, "score": 0.0})
            on = frame["lettered"].to_numpy(bool)
            if on.any():
                names, scores = predict(model, frame["text"][on].tolist())
                out.loc[on, "lang_pred"], out.loc[on, "score"] = names, scores
            yield out

    found = rows.mapInPandas(run, "doc_id string, lang_pred string, score double")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def report(docs: DataFrame, **options) -> DataFrame:
    """Learns from the documents that are not held out and predicts all."""
    learn = docs.where(~held_out(docs["doc_id"])).select(F.col("doc_id").alias("id"), "lang", "text")
    found = identify(docs, train(learn, **options))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
