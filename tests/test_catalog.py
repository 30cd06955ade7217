"""Every query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_file

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)
QUERIES, SQL = entry_file.queries(), entry_file.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    if name not in SQL:
        assert got
        return
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, got) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry_file.entry(spark).columns == ["fid", "b3_bag_bag_overlap"]
