"""Queries with SQL against DuckDB over the whole sf0.001 tables."""

from __future__ import annotations

import pytest

from ledgerlake.llm.registry import QUERIES
from tests.llm.conftest import SF


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_matches_oracle(spark, duck, name):
    fn, sql = QUERIES[name]
    got = fn(spark, SF)
    want = duck.sql(sql)
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.select(*got.columns).fetchall(), key=str)
