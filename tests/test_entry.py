"""Driver contract: entry, catalogue and oracle agree at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["user_idx", "product_idx", "Score"]
    assert df.count() == 3169


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(rows):
    def v(x):
        if isinstance(x, float):
            return round(x, 6)
        return x
    return sorted(repr(tuple(v(x) for x in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)
    mine = [tuple(r[c] for c in order) for r in df.collect()]
    idx = [ocols.index(c) for c in order]
    theirs = [tuple(r[i] for i in idx) for r in res.fetchall()]
    assert _norm(mine) == _norm(theirs)
    assert not math.isnan(len(mine))
