"""Every registered query against its DuckDB twin on the smallest driver tables, plus the
entry-point contract."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from chronoweave.workloads import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def key(row):
    return tuple((x is None, type(x).__name__ if x is not None else "", x if x is not None else 0) for x in row)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=key)
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    exp = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=key)
    assert got == exp


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["timestamp", "view", "click", "purchase", "signup", "error"]
    assert df.count() == 720
