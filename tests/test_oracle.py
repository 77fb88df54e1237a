"""Every registered query against its SQL on the same files."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "null" if math.isnan(v) else repr(v + 0.0)
    return "null" if v is None else str(v)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    names = sorted(df.columns)
    got = sorted(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in names]).collect())
    result = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == names
    order = [columns.index(c) for c in names]
    want = sorted(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    assert got == want


def test_registry_covers_oracle():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert len(df.columns) == 50 and df.count() == 973
