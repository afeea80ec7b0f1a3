"""Operators against brute force outside Spark (pandas / Python decimals)."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.functions.money import line_amount
from tillroll.operators.dedup import dedup_transactions
from tillroll.plans.pipeline import raw_table
from tillroll.schema import RAW_COLUMNS


def test_dedup_matches_pandas_sort_first(spark, sf_small):
    raw = raw_table(spark, sf_small)
    pdf = raw.toPandas()
    rest = [c for c in RAW_COLUMNS if c != "transaction_id"]
    want = (
        pdf.sort_values(rest, na_position="first", kind="mergesort")
        .groupby("transaction_id", dropna=False, sort=False)
        .head(1)
    )
    got = dedup_transactions(raw).toPandas()
    key = lambda df: sorted(map(tuple, df[RAW_COLUMNS].astype(object).where(df[RAW_COLUMNS].notna(), None).values.tolist()), key=str)
    assert len(got) == len(want) == pdf["transaction_id"].nunique(dropna=False)
    assert key(got) == key(want)


@settings(max_examples=25, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(min_value=0, max_value=99_999_99).map(lambda c: c / 100),
            st.integers(min_value=0, max_value=500),
            st.sampled_from([0.0, 5.0, 10.0, 15.0, 20.0, 33.0]),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_line_amount_is_exact_half_up(spark, rows):
    df = spark.createDataFrame(rows, "p double, q int, d double")
    got = [r.a for r in df.select(line_amount("p", "q", "d").alias("a")).collect()]
    for (p, q, d), a in zip(rows, got):
        exact = (Decimal(str(p)) * q * (100 - Decimal(int(d))) / 100).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert a == exact, (p, q, d, a, exact)
