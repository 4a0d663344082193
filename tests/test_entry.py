"""Driver contract: entry runs, every query has SQL, a few queries equal
their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL


def test_entry_runs(spark, duck):
    df = E.entry(spark)
    assert df.columns == ["serving_cell", "neighbor_cell", "mean_s", "mean_n", "var_s",
                          "cov_sn", "var_n", "cnt"]
    assert df.count() == len(duck.sql(E.oracle_sql()["pair_stats"]).fetchall()) > 0


NAMES = sorted(E.QUERIES)


def test_every_query_has_sql():
    assert set(NAMES) <= set(E.queries())
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    res = duck.sql(E.oracle_sql()[name])
    assert sorted(res.columns) == cols
    want = sorted((tuple(row[res.columns.index(c)] for c in cols) for row in res.fetchall()), key=repr)
    assert got == want
