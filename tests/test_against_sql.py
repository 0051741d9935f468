"""Every query with SQL gives exactly the rows that DuckDB gives on the same tables."""

from __future__ import annotations

import pytest

from linkrisk.catalog import QUERIES, SQL
from tests.checking import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_sql_only_for_known_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    difference, _, _ = compare(spark, con, QUERIES[name], SQL[name], SF_DIR)
    assert difference is None
