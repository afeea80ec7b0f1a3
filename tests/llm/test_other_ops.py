"""Token counts, language identification, near-duplicates, the pipeline."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import LONG, ROWS, documents, empty
from tillroll.llm import kernel_language, order_minhash, prefix_tokens
from tillroll.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(prefix_tokens.VOCABULARY))
    return lambda s: len(t.encode(s, add_special_tokens=False).ids)


def test_every_prefix_counts_as_the_library_says(library):
    c = prefix_tokens.counter(prefix_tokens.VOCABULARY)
    rnd = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABEST '''.,;!?0123456789éÉüßñĲİΣςǅ́̈한글字日<|end\n\t \x85\x1cẛ̣😀"
    heads, tails = ["don't", "we'll've", "<|endoftext|>", "x<|startoftext|>y", "!!'re", "THEY'RE"], ["'s", "<|endoftext|>!", " it's", "<|end"]
    for i in range(700):
        s = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 25)))
        s = rnd.choice(heads) + s + rnd.choice(tails) if i % 3 == 0 else s
        p = c.prefixes(s)
        assert [int(x) for x in p] == [library(s[:j]) for j in range(len(s) + 1)], repr(s)
        assert c.count(s) == library(s)
        limit = rnd.randint(0, 12)
        cut = c.cut(s, limit)
        assert library(s[:cut]) <= limit and (cut == len(s) or s[cut:].strip() != "")


def test_token_counts_of_rows(spark, library):
    docs = table(spark, SF, "documents").select("doc_id", "text").union(documents(spark).select("doc_id", "text"))
    want = collections.Counter((r.doc_id, len((r.text or "").encode()), library(r.text or "")) for r in docs.collect())
    got = prefix_tokens.report(docs).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    long = next(r for r in got if r.n_bytes == len(LONG))
    assert library(LONG[: long.cut_chars]) <= 2048 < library(LONG[: long.cut_chars + 8])
    assert prefix_tokens.report(empty(spark)).count() == 0
    stored = prefix_tokens.token_counts(documents(spark), with_prefixes=True).where("doc_id = 8").first()
    assert stored.prefixes[-1] == stored.n_tokens and len(stored.prefixes) == len(ROWS[-1][1]) + 1


def test_language_of_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = kernel_language.report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    rows = kernel_language.report(documents(spark).withColumn("score", F.lit("x"))).collect()
    assert len(rows) == len(ROWS)
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {2, 3, 7} <= und and not und & {1, 4, 5, 6, None}
    assert kernel_language.report(empty(spark)).count() == 0


def test_presence_kernel_against_sets():
    texts = ["Ab cd!", "abcd", "", "Éa 12 b"]
    fold = lambda t: "".join(c if c != " " else " " for c in " " + " ".join("".join(x.lower() if x.isalpha() else " " for x in t).split()) + " ")
    grams = [{f[i : i + n] for n in (1, 2, 3) for i in range(len(f) - n + 1)} for f in map(fold, texts)]
    rows = kernel_language.presence(texts)
    for i in (0, 1, 3):
        for j in (0, 1, 3):
            exact = len(grams[i] & grams[j]) / (len(grams[i]) * len(grams[j])) ** 0.5
            assert kernel_language.kernel(rows[i : i + 1], rows[j : j + 1])[0, 0] == pytest.approx(exact, abs=0.05)


def _brute_classes(texts):
    """Components of all pairs, by plain dynamic programming on labelled k-mers."""

    def labelled(t):
        w, seen = t.lower().split(), collections.Counter()
        out = []
        for i in range(max(1, len(w) - 4)) if w else ():
            k = tuple(w[i : i + 5])
            seen[k] += 1
            out.append((k, seen[k]))
        return out

    def matched(a, b):
        band = int((len(a) + len(b)) / 9 + 1e-9)
        row = np.zeros(len(b) + 1, int)
        for i, x in enumerate(a):
            new = row.copy()
            for j, y in enumerate(b):
                new[j + 1] = max(row[j + 1], new[j], row[j] + 1 if x == y and abs(i - j) <= band else 0)
            row = new
        return row[-1]

    ids, kmers = list(texts), {i: labelled(t or "") for i, t in texts.items()}
    of = {i: i for i in ids}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = kmers[i], kmers[j]
            both = len(set(a) & set(b))
            if a and b and both >= 0.8 * (len(a) + len(b) - both):
                m = matched(a, b)
                if m >= 0.8 * (len(a) + len(b) - m):
                    x, y = sorted((find(i), find(j)))
                    of[y] = x
    return {i: find(i) for i in ids}


def _edited(rnd, words, n):
    out = list(words)
    for _ in range(n):
        at = rnd.randrange(len(out))
        out[at : at + 1] = rnd.choice([[f"new{rnd.randrange(10**6)}"], [], [out[at], f"more{rnd.randrange(10**6)}"]])
    return " ".join(out)


@pytest.mark.parametrize("small", [2, 16])
def test_classes_equal_all_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(order_minhash, "SMALL_BUCKET", small)
    rnd = random.Random(11)
    base = [f"w{rnd.randrange(4000)}" for _ in range(120)]
    shared = " ".join(f"s{i}" for i in range(60))
    texts = {i: _edited(rnd, base, i % 9) for i in range(70)}  # a group of near copies, some too far
    texts |= {100 + i: f"{shared} " + " ".join(f"o{rnd.randrange(10**6)}" for _ in range(25)) for i in range(30)}
    texts |= {200 + i: " ".join(f"u{rnd.randrange(10**6)}" for _ in range(80)) for i in range(20)}
    words = texts[200].split()
    texts |= {300: " ".join(words[40:] + words[:40]), 301: texts[200].upper() + " ", 302: "one two", 303: "one two", 304: "two one"}
    texts |= {310 + i: " ".join(words[: 80 - 4 * i]) for i in range(6)}  # a chain of ever shorter copies
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in order_minhash.report(docs).collect()}
    assert got == _brute_classes(texts)


def test_near_duplicates_of_odd_rows(spark):
    docs = documents(spark)
    got = sorted((str(r.doc_id), r.class_id) for r in order_minhash.report(docs).collect())
    assert got == [("1", 1), ("2", 2), ("3", 3), ("4", 4), ("5", 5), ("5", 5), ("6", 5), ("7", 7), ("8", 8), ("None", None)]
    kept = order_minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "7", "8", "None"]
    assert order_minhash.report(empty(spark)).count() == 0 == order_minhash.keep_one(empty(spark)).count()


def test_near_duplicates_return_only_what_is_exact(spark):
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    texts = [(i, _edited(rnd, base, 1), None, None) for i in range(12)]  # a class whose members are not all compared
    got = order_minhash.report(documents(spark, texts))
    assert got.columns == ["doc_id", "class_id"]
    assert {(r.doc_id, r.class_id) for r in got.collect()} == {(i, 0) for i in range(12)}


def test_pipeline_stages_by_hand(spark):
    import corpus_pipeline as P
    from tests.llm.test_native_ops import _statistics

    docs = table(spark, SF, "documents")
    seen = {}
    for name, stage in P.STAGES:
        docs = stage(spark, docs, SF)
        docs.write.mode("overwrite").parquet(path := f"{spark.sparkContext.getCheckpointDir()}/stage-{name}")
        docs = spark.read.parquet(path)
        seen[name] = docs
        if name != P.STAGES[-1][0]:
            assert docs.columns == table(spark, SF, "documents").columns
    ids = lambda name: {r.doc_id for r in seen[name].select("doc_id").collect()}
    text = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    assert not any(_statistics(text[i])[-1] for i in ids("quality"))
    classes = _brute_classes({i: text[i] for i in sorted(ids("quality"))})
    assert ids("near_duplicates") == set(classes.values())
    plain = lambda t: " ".join(t.lower().split())
    items = [plain(r.text) for r in table(spark, SF, "benchmark").collect()]
    assert ids("decontaminate") == {i for i in ids("near_duplicates") if not any(x in plain(text[i]) for x in items)}
    copies = collections.Counter(r.doc_id for r in seen["mix"].select("doc_id").collect())
    assert set(copies) <= ids("decontaminate") and max(copies.values()) <= 2
    assert seen["shard"].count() == seen["mix"].count()
    assert P.run(spark, SF).count() == seen["shard"].count()


def test_finer_buckets_take_the_rarest_kmers_needed(spark, capsys):
    rng, rows = random.Random(5), []
    for i in range(60):
        beyond = sorted((rng.randint(2, 9), rng.randrange(40)) for _ in range(rng.randrange(12)))
        rows.append((bytes([i % 2]), bytes([9, i]), rng.randint(4, 60), len(beyond) + rng.randrange(4), 0, beyond or None))
    seen = spark.createDataFrame(rows, "centre binary, node binary, n int, x long, a long, beyond array<struct<df:long,k:long>>")
    placed = []
    for centre, node, n, x, _, beyond in rows:
        alone = x - len(beyond or [])
        placed += [(centre, k, node) for at, (_, k) in enumerate(beyond or [], 1) if at + alone <= n // 4 + 1]
    sizes = collections.Counter((c, k) for c, k, _ in placed)
    want = sorted((sizes[c, k], node) for c, k, node in placed if sizes[c, k] > 1)
    found = order_minhash.finer_buckets(seen)
    assert sorted((r.size, bytes(r.node)) for r in found.collect()) == want and want
    found.explain()
    assert "Window" not in capsys.readouterr().out
