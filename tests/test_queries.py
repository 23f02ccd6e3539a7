"""Every registered query against its SQL on DuckDB, or for rows where SQL cannot say it."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canon, close
from fundloom.plans import all_queries, registry

all_queries.load()
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, duck, folder):
    df = QUERIES[name](spark, folder)
    cur = duck.execute(ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    mine, theirs = canon(df.collect(), df.columns), canon(cur.fetchall(), cols)
    assert len(mine) == len(theirs)
    assert all(close(a, b) for a, b in zip(mine, theirs))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(name, spark, folder):
    assert QUERIES[name](spark, folder).limit(1).count() == 1


def test_entry(spark):
    assert entry.entry(spark).count() == 3


def test_names():
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
