"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver repeats this at sf0.01)."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlake.plans.catalog import CATALOG
from tests.conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(CATALOG) <= set(entry.queries())
    assert set(CATALOG) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    drecs = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert _rows(sdf.collect(), cols) == _rows(drecs, cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert len(df.columns) == 25


_SPARK = {"int": "integer", "bigint": "bigint", "double": "double", "string": "string", "boolean": "boolean", "date": "date"}
_DUCK = {"INTEGER": "integer", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date"}


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_types_match_oracle(spark, duck, name):
    """The driver compares schemas too: both sides must produce the same type
    family per column (no DECIMAL literal against a DOUBLE, no INT vs BIGINT)."""
    stypes = {c: _SPARK.get(t, t) for c, t in entry.queries()[name](spark, SF001).dtypes}
    rel = duck.sql(entry.oracle_sql()[name])
    dtypes = {c: _DUCK.get(str(t).upper(), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert stypes == dtypes
