"""Every registered query runs, and equals its SQL where there is any."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int | float) or hasattr(v, "dtype"):
        return "None" if isinstance(v, float) and math.isnan(v) else repr(round(float(v), 6) + 0.0)
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, small, name):
    df = QUERIES[name](spark, small)
    got = df.collect()
    assert df.columns and len(set(df.columns)) == len(df.columns)
    if name in SQL:
        found = db.execute(SQL[name])
        names = [c[0] for c in found.description]
        assert sorted(names) == sorted(df.columns)
        assert rows(df.columns, got) == rows(names, found.fetchall())


def test_flagship(spark, small):
    df = entry.entry(spark)
    assert df.columns == ["station", "t", "p"] and df.count() > 0
