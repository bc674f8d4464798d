"""Every registered query with SQL gives the same rows as DuckDB on the small tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from statkit import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf}/{name}.parquet"
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    return value.isoformat() if isinstance(value, (datetime.date, datetime.datetime)) else value


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_equals_duckdb(spark, sf, duck, name):
    found = plans.QUERIES[name](spark, sf)
    columns = sorted(found.columns)
    want = duck.sql(plans.ORACLE[name])
    assert sorted(want.columns) == columns
    place = [want.columns.index(c) for c in columns]
    assert ordered(tuple(plain(r[c]) for c in columns) for r in found.collect()) == ordered(tuple(plain(r[i]) for i in place) for r in want.fetchall())


def test_queries_without_sql(spark, sf):
    for name in set(plans.QUERIES) - set(plans.ORACLE):
        assert plans.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["nation", "period", "name", "n", "urgent", "rate"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
