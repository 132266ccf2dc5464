from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture()
def docs(spark):
    """Nulls, empty and repeated rows, ties, and an extra column with a clashing name."""
    rows = [(1, None, "s1", 0), (2, "", "s2", 0), (3, "Alpha beta GAMMA", None, 1), (3, "Alpha beta GAMMA", None, 1), (None, "alpha BETA gamma", "s1", 2),
            (5, "é ü 日本 " * 3000, "s3", 3), (6, "alpha beta gamma", "s2", 4)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, rid bigint")
