"""The queries that SQL can express give DuckDB's rows."""

import os

import duckdb
import pytest

from statkit.llm import queries

TABLES = ("documents", "embeddings", "conversations", "benchmark")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_duckdb(spark, sf, name):
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf}/{table}.parquet"
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    found, want = queries.QUERIES[name](spark, sf), con.sql(queries.ORACLE[name])
    columns = sorted(found.columns)
    assert sorted(want.columns) == columns
    place = [want.columns.index(c) for c in columns]
    key = lambda row: tuple(map(str, row))
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=key) == sorted((tuple(r[i] for i in place) for r in want.fetchall()), key=key)
