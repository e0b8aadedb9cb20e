"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(SQL)))
def test_query_agrees_with_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    got = Counter(tuple(_plain(row[c]) for c in columns) for row in frame.collect())
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = Counter(tuple(_plain(row[names.index(c)]) for c in columns) for row in cursor.fetchall())
    assert got == want


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
