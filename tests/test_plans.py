"""Plan shape guards: pushdown, pruning, no pair explosion."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from ratewise.sources import fixtures


def _plan(df) -> str:
    """The formatted physical plan (scan metadata printed in full)."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_fixture_scan_reads_every_line_and_prunes(spark):
    plan = _plan(fixtures.reviews(spark, SF001))
    assert "EqualTo(" not in plan
    assert fixtures.reviews(spark, SF001).count() == spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    assert ("ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,"
            "l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz>") in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_no_cross_product_in_any_query(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name} plans a {bad}"


def test_no_row_at_a_time_python(spark):
    for name in ("topk_all", "cleaned_ratings", "serve_user", "json_roundtrip", "pair_scores"):
        plan = _plan(E.queries()[name](spark, SF001))
        assert "BatchEvalPython" not in plan  # plain Python UDFs never appear
