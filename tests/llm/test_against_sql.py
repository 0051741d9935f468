"""The queries that SQL can express give exactly the rows that DuckDB gives."""

from __future__ import annotations

import pytest

from linkrisk.llm.queries import QUERIES, SQL
from tests.checking import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, name):
    difference, _, _ = compare(spark, connect(SF_DIR), QUERIES[name], SQL[name], SF_DIR)
    assert difference is None


def test_one_query_for_each_operator():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
