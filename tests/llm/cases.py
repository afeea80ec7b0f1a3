"""Rows that every operator must take: nulls in any column, empty and long texts, repeated
rows, ties, extra columns with clashing names."""

from __future__ import annotations

LONG = " ".join(f"word{i % 97} and{i % 13}" for i in range(6000))
SECRET = 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs home again.\n" + SECRET, "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (None, "no id here but some words to count in this little text", "en", None),
    (4, LONG, "en", "b"),
    (5, "same text same words same day same place same time again", "en", "b"),
    (5, "same text same words same day same place same time again", "en", "b"),
    (6, "same text same words same day same place same time again", "de", "c"),
    (7, " \t\n ", "fr", "c"),
    (8, "😀 é ß \x1c <|endoftext|> don't", "fr", "c"),
]
# clashing names: columns that operators use inside or return
SCHEMA = "doc_id long, text string, lang string, source string"
EXTRA = ("size", "shard", "key", "node", "n", "kept", "k1", "group", "_rk", "copies", "comp", "a", "b")


def documents(spark, rows=None):
    from pyspark.sql import functions as F

    rows = ROWS if rows is None else rows
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in EXTRA})


def empty(spark):
    return documents(spark).limit(0)
