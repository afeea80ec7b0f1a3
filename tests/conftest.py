from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import local_session

    s = local_session("*", shuffle_partitions=8, app="tillroll-tests")
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)


def raw_rows(spark, rows):
    """Raw-schema frame from tuples (missing trailing fields are NULL)."""
    from pyspark.sql.types import StructField, StructType

    from tillroll.schema import RAW_SCHEMA

    # as read from a file: every column nullable (CSV does not enforce the declaration)
    schema = StructType([StructField(f.name, f.dataType, True) for f in RAW_SCHEMA.fields])
    n = len(schema.fields)
    return spark.createDataFrame([tuple(r) + (None,) * (n - len(r)) for r in rows], schema)
