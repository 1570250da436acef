"""Every registered query with SQL against DuckDB on the driver tables."""

import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def canon(rows, columns):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in at) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    sql = con.sql(entry.oracle_sql()[name])
    types = dict(zip(sql.columns, map(str, sql.types)))
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == types
    assert canon(rows, df.columns) == canon(sql.fetchall(), sql.columns)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 6
