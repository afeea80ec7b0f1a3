"""Alignment of two tokenizers against the libraries and plain loops."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import LONG, ROWS, documents, empty
from tillroll.llm import token_alignment
from tillroll.llm.common import table
from tillroll.llm.queries import op11_token_alignment

SF = "/root/testdata/sf0.001"
ODD = [
    (-3, "a▁b"), (-4, "<s> <|endoftext|> 😀 é</s> \x00 x <0x0A> <unk>"), (None, "  lead  \n\n trail  "), (-6, "x" * 5000),
    (-7, " " * 3000 + "y"), (-8, " "), (-9, "ﬁ ﷺ ḍ̇ 한글 日本 ​ ﻿"), (-10, "\n\t"), (-10, "\n\t"),
]


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def token_bytes(libraries):
    t, sp = libraries
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    a = {i: bytes(byte[c] for c in s) if i != 50256 else s.encode() for s, i in t.get_vocab().items()}
    b = {}
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        b[i] = bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
    return a, b


def brute(libraries, rows):
    t, sp = libraries
    a_bytes, b_bytes = token_bytes(libraries)
    per, count = [], collections.Counter()
    for doc_id, text in rows:
        a = t.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            per.append((doc_id, 0, 0, 0, [], ""))
            continue
        ends = lambda ids, of: dict(zip(np.cumsum([len(of[i]) for i in ids]).tolist(), range(1, len(ids) + 1)))
        ea, eb = ends(a, a_bytes), ends(b, b_bytes)
        groups, links, i, j = [], [], 0, 0
        for x in sorted(set(ea) & set(eb)):
            groups.append(",".join(map(str, a[i : ea[x]])) + "|" + ",".join(map(str, b[j : eb[x]])))
            i, j = ea[x], eb[x]
            links.append((a[i - 1], b[j - 1]))
        count.update(links)
        per.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = collections.Counter()
    for (_, y), c in count.items():
        top[y] = max(top[y], c)
    return collections.Counter(
        (d, n, m, g, len(x), sum(count[p] == top[p[1]] for p in x), sum(count[p] for p in x), h) for d, n, m, g, x, h in per
    )


def counted(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_documents_against_the_libraries(spark, libraries):
    odd = spark.createDataFrame(ODD, "doc_id long, text string")
    docs = table(spark, SF, "documents").select("doc_id", "text").union(odd).union(documents(spark).select("doc_id", "text"))
    want = brute(libraries, [(r.doc_id, r.text) for r in docs.collect()])
    got = token_alignment.report(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert counted(got) == want
    assert sum(n > 0 for _, n, *_ in want) > 50 and (-3, 0, 0, 0, 0, 0, 0, "") in want


def test_any_share_of_broadcast_links_gives_the_same(spark):
    docs = table(spark, SF, "documents")
    want = counted(token_alignment.report(docs))
    for hot in (0, 40):
        assert counted(token_alignment.report(docs, hot_links=hot)) == want


def test_both_ways_to_encode_agree(libraries):
    """tiktoken with the file's merges against tokenizers, on random texts."""
    v = token_alignment.vocabularies(token_alignment.A_FILE, token_alignment.B_FILE)
    assert v.fast is not None
    rnd = random.Random(2)
    parts = ["don't", "'LL", " we've", "  ", "\n\n", "\t", "\r\n ", "12345", "½", "éÉ", "日本", "😀", "́", "...", "<|endoftext|>", " x", "Ab", "\x00", "\x85", " "]
    for _ in range(500):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 30)))
        assert v.encode_a(text).tolist() == libraries[0].encode(text, add_special_tokens=False).ids, repr(text)


def test_groups_of_random_tilings():
    rnd = random.Random(1)
    for _ in range(200):
        n = rnd.randint(1, 40)
        ends = [np.array(sorted({n, *(rnd.randint(1, n) for _ in range(rnd.randint(0, 12)))})) for _ in range(2)]
        both = sorted(set(ends[0]) & set(ends[1]))
        got = token_alignment.coalesce(*ends)
        for e, g in zip(ends, got):
            assert g.tolist() == [sum(c < x for c in both) for x in e]


def test_odd_tables(spark):
    assert token_alignment.report(empty(spark)).count() == 0
    assert token_alignment.report(documents(spark).where("text is null")).first().groups_sha256 == ""
    clash = documents(spark).withColumns({c: F.lit("x") for c in ("links", "times", "link", "count", "best", "_row", "n_a")})
    assert token_alignment.report(clash).count() == len(ROWS)
    raw = spark.createDataFrame([(1, bytearray(b"ok \xff\xfe bad"))], "doc_id long, text binary")
    assert tuple(token_alignment.report(raw).first())[1:] == (0, 0, 0, 0, 0, 0, "")
    long = token_alignment.report(spark.createDataFrame([(1, LONG * 20)], "doc_id long, text string")).first()
    assert long.n_links > 100_000


def test_query(spark):
    assert op11_token_alignment(spark, SF).count() == table(spark, SF, "documents").count()
