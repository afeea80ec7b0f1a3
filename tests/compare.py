"""Spark result vs DuckDB oracle: row count, column names/kinds, order-insensitive values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) if digits is not None else v
    if isinstance(v, decimal.Decimal):
        return round(float(v), digits) if digits is not None else float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_key(columns, rows, digits=None):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark_df, con, sql, digits=None):
    """Returns (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_key(s_cols, s_rows, digits), rows_key(d_cols, d_rows, digits)
    if a != b:
        for x, y in zip(a, b):
            if x != y:
                return False, f"first diff: spark={x} duck={y} (cols {sorted(s_cols)})"
    return True, f"{len(s_rows)} rows"


_SPARK_TO_DUCK = {
    "IntegerType()": "INTEGER",
    "LongType()": "BIGINT",
    "BooleanType()": "BOOLEAN",
    "DoubleType()": "DOUBLE",
    "StringType()": "VARCHAR",
    "DateType()": "DATE",
}


def type_diff(spark_df, con, sql) -> dict:
    """Columns whose Spark type and DuckDB result type differ (empty when aligned)."""
    s = {f.name: _SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in spark_df.schema.fields}
    rel = con.sql(sql)
    d = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {k: (s.get(k), d.get(k)) for k in set(s) | set(d) if s.get(k) != d.get(k)}
