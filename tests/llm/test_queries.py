"""Registered queries against their SQL, and the entry module's contract."""
import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from ratewise.llm import queries

SF001 = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    names = set(__spark_entry__.queries())
    for n in range(1, 14):
        assert any(x.startswith(f"op{n}_") for x in names)
    assert "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    got = queries.queries()[name](spark, SF001)
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    want = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == sorted(want.fetchall(), key=key)
