"""Every registered query on the smallest data set, against DuckDB where a statement exists."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_statements_belong_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_flagship(spark):
    assert entry(spark).count() == 150


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        assert compare(name, df, con, SQL[name]).startswith("ok")
    else:
        assert df.count() > 0
