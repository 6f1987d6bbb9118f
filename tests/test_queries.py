"""Every registered query with SQL for it, against DuckDB on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in found), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_duckdb(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    got = df.collect()
    c = duck.execute(entry.oracle_sql()[name])
    columns = [x[0] for x in c.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, got) == rows(columns, c.fetchall())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_others_run(spark, sf, name):
    df = entry.queries()[name](spark, sf)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    assert os.path.isdir("/root/testdata/sf0.001") and entry.entry(spark).count() > 0
