"""Personal data against plain regular expressions."""

from __future__ import annotations

import collections
import hashlib
import re

import regex
from pyspark.sql import functions as F

from tests.llm.cases import LONG, ROWS, documents, empty
from tillroll.llm import private_data
from tillroll.llm.common import table
from tillroll.llm.queries import op13_private_data

SF = "/root/testdata/sf0.01"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ODD = [
    "a@b.c_x@y.z %@a.b a@b a@b. a@b@c.d ..@x-.y- é@é.fr ü.a@b.c",
    "300.1.2.3.4.5.6.7 0010.002.3.255 1.2.3 1.2.3.4.5 256.1.1.1 99999999999.1.1.1 a1.2.3.4b",
    "4111 1111 1111 1111 4111-1111-1111-1111-2 4111  1111 1111 1111 2020 4111 1111 1111 1111 5500005555555559",
    "+1 2 +12345678 +1 (2) 3-4.5 678901234 + 1 +49 30 1234567890123456 ++44 20 7946 0958- +1()",
    "😀 call 555 123 4567, é ssn 123-45-6789, order 123-45-6789, 123-45-6789",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 but DE88370400440532013000",
    "visa 4111 1111 1111 1111 7777 then 2020 4111-1111-1111-1111",
    "phone (555) 123-4567 version 555-123-4567; (555) 123-4567",
    "1" * 5000 + " " + "a" * 5000 + "@ " + "1." * 3000 + " +" + "1 " * 3000,
    "her ssn is 123-45-6789.",
    "x@y.z " * 300,
]


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def valid(kind, s):
    n = sum(c.isdigit() for c in s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 16 <= n <= 19 and luhn(s)
    return kind != "phone" or 8 <= n <= 15


def base(text):
    return [
        (k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text) if valid(k, m.group())
    ]


def iban(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def weak(text, taken):
    out = []
    for k in private_data.WEAK:
        hits = list(regex.finditer(k.pattern, text))
        ends = [0] + [m.end() for m in hits]
        starts = [m.start() for m in hits] + [len(text)]
        mine = []
        for i, m in enumerate(hits):
            around = text[max(ends[i], m.start() - private_data.BEFORE) : m.start()] + "\n"
            around += text[m.end() : min(starts[i + 1], m.end() + private_data.AFTER)]
            word = lambda w, a=around: regex.search(rf"(?<!\p{{L}})(?:{w})(?!\p{{L}})", a, regex.I) is not None
            score = k.score + 0.3 * word(k.words) - 0.4 * word(private_data.OTHER)
            check = {"iban": iban, "card_groups": luhn}.get(k.name, lambda s: True)
            if check(m.group()) and round(score, 2) >= private_data.MIN_SCORE:
                if not any(a < m.end() and e > m.start() for _, a, e in taken + out):
                    mine.append((k.name, m.start(), m.end()))
        out += mine
    return out


def shown(spans):
    return ",".join(f"{k}:{a}:{e}" for k, a, e in spans)


def test_spans_against_regular_expressions(spark):
    odd = spark.createDataFrame(list(enumerate(ODD, 10_000)), "doc_id long, text string")
    docs = table(spark, SF, "documents").select("doc_id", "text").union(odd).union(documents(spark).select("doc_id", "text"))
    want = collections.Counter()
    for r in docs.collect():
        text = r.text or ""
        found = base(text)
        n = collections.Counter(k for k, _, _ in found)
        extra = weak(text, found)
        want[(r.doc_id, *(n[k] for k in BASE), hashlib.sha256(shown(found).encode()).hexdigest(), shown(found + extra), len(extra))] += 1
    got = collections.Counter(tuple(r) for r in private_data.report(docs).collect())
    assert got == want
    added = [k for row in want for k in (s.split(":")[0] for s in row[6].split(",") if s)]
    assert {"iban", "card_groups", "local_phone", "ssn"} <= set(added)


def test_what_the_context_decides(spark):
    rows = [(1, "ssn 123-45-6789"), (2, "order 123-45-6789"), (3, "ssn order 123-45-6789"), (4, "call 555 123 4567"), (5, "555 123 4567")]
    got = {r.doc_id: [s.score for s in r.found] for r in private_data.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [0.8], 2: [], 3: [], 4: [0.7], 5: []}


def test_redaction(spark):
    rows = [(1, "mail a@b.c, call 555 123 4567 or +1 (555) 555-0100."), (2, None), (3, ""), (4, "no 1.2.3.400 or 1.2.3.4")]
    got = private_data.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.text for r in got] == ["mail <email>, call <local_phone> or <phone>.", None, "", "no 1.2.3.400 or <ip>"]
    again = private_data.redact(documents(spark))
    assert again.columns == documents(spark).columns
    assert sorted(r.text or "" for r in again.collect()) == sorted(r[1] or "" for r in ROWS)


def test_odd_tables(spark):
    assert private_data.report(empty(spark)).count() == 0
    clash = documents(spark).withColumns({c: F.lit("x") for c in ("base", "found", "spans", "w4", "start", "kind")})
    assert private_data.report(clash).count() == len(ROWS)
    long = spark.createDataFrame([(1, (LONG + " a@b.cd ") * 100)], "doc_id long, text string")
    assert private_data.report(long).first().n_email == 100


def test_query(spark):
    assert op13_private_data(spark, "/root/testdata/sf0.001").count() == table(spark, "/root/testdata/sf0.001", "documents").count()
