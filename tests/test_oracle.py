"""Every registered query against its DuckDB oracle on the smallest test data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck, type_diff
from tillroll.registry import QUERIES

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
NAMES = sorted(QUERIES)  # the optional subpackage tests its own queries


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    assert name in SQL, f"{name} has no oracle SQL"
    df = entry.queries()[name](spark, SF)
    ok, msg = compare(df, con, SQL[name])
    assert ok, msg
    assert not type_diff(df, con, SQL[name]), type_diff(df, con, SQL[name])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["category", "total_revenue", "num_transactions", "avg_order_value"]
