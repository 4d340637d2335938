"""Every registered query with SQL gives the same rows as DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

FOLDER = os.environ.get("SHEAFLINE_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for p in sorted(glob.glob(f"{FOLDER}/*.parquet")):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return int(v) if isinstance(v, bool) else v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = queries()[name](spark, FOLDER)
    want = duck.sql(oracle_sql()[name])
    a, b = rows(got.columns, got.collect()), rows(want.columns, want.fetchall())
    assert a[0] == b[0]
    assert len(a[1]) == len(b[1])
    assert a[1] == b[1]
