"""Serving datasets: clamps, defaults, latest list, overview, random user."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ratewise import config
from ratewise.operators import serve
from ratewise.sinks.writers import write_batch_lists
from ratewise.sources import store

SCHEMA = "user_idx int, recommendations array<struct<product_idx:int,rating:float>>"


def _lists(n_items=20):
    return [(u, [(100 * u + i, float(30 - i)) for i in range(n_items)]) for u in (1, 2, 3)]


@pytest.fixture()
def lists(spark):
    return spark.createDataFrame(_lists(), SCHEMA)


def test_lookup_clamps_n(spark, lists):
    req = spark.createDataFrame([(1, 0), (2, 5), (3, 99), (1, None), (7, 3)], "user_id int, n int")
    got = {(r.user_id, r.n_used): r for r in serve.lookup(req, lists).collect()}
    assert got[(1, 1)].total == 1 and got[(1, 1)].recommendations == ["Product_100"]
    assert got[(2, 5)].total == 5
    assert got[(3, 20)].total == 20
    assert got[(1, 5)].total == 5                    # null -> default 5
    assert got[(7, 3)].status == "unknown" and got[(7, 3)].total == 0
    d = got[(2, 5)].details[0]
    assert (d.product_id, d.product_idx, d.score) == ("Product_200", 200, 30.0)


def test_unknown_user_hint(spark, lists):
    req = spark.createDataFrame([(999999999, None)], "user_id int, n int")
    r = serve.unknown_users(req, lists).first()
    assert r.status == "unknown" and r.hint == "1, 2, 3" and r.total_users == 3


def test_empty_store_answer_and_totals(spark, lists):
    req = spark.createDataFrame([(1, None), (1, 3)], "user_id int, n int")
    got = serve.unknown_users(req, spark.createDataFrame([], SCHEMA)).collect()
    assert [(r.error, r.hint_text, r.total_users) for r in got] == [(config.EMPTY_STORE_ERROR, None, 0)]
    assert {r.total_users for r in serve.overview(lists, 2).collect()} == {3}
    assert {r.total for r in serve.user_directory(lists, 1).collect()} == {3}


@pytest.mark.parametrize("limit,expect", [(-1, 0), (0, 0), (2, 2), (20, 3), (None, 3)])
def test_overview_limit(spark, lists, limit, expect):
    ov = serve.overview(lists, limit).collect()
    assert len(ov) == expect
    for r in ov:
        assert len(r.top5) == 5


def test_latest_list_wins(spark, tmp):
    b0 = spark.createDataFrame([(1, [(10, 1.0)]), (2, [(20, 2.0)])], SCHEMA)
    b1 = spark.createDataFrame([(1, [(11, 3.0)])], SCHEMA)
    write_batch_lists(b0, tmp, 0)
    write_batch_lists(b1, tmp, 1)
    write_batch_lists(b1, tmp, 1)  # replay of batch 1: overwritten, not appended
    st = store.read_store(spark, tmp)
    assert st.count() == 3
    latest = {r.user_idx: r for r in serve.latest_lists(st, store.STORE_ORDER).collect()}
    assert latest[1].recommendations[0].product_idx == 11 and latest[1].batch_id == 1
    assert latest[2].recommendations[0].product_idx == 20


def test_random_user_reproducible_and_empty(spark, lists):
    a = serve.random_user(lists).collect()
    b = serve.random_user(lists).collect()
    assert len(a) == 1 and a == b
    empty = spark.createDataFrame([], SCHEMA)
    assert serve.random_user(empty).count() == 0


def test_display_rows(spark):
    df = spark.createDataFrame([(1, [(5, 6.0), (6, 3.0), (7, 0.0)])], SCHEMA)
    rows = serve.display_rows(df).orderBy("rank").collect()
    assert [r.rank for r in rows] == [1, 2, 3]
    # 6 / (6*1.2) * 100 = 83.33 -> 83 ; 3 / 7.2 * 100 = 41.67 -> 42
    assert [r.bar_pct for r in rows] == [83, 42, 0]


def test_user_directory_cap(spark):
    many = spark.createDataFrame([(u, [(1, 1.0)]) for u in range(250, 0, -1)], SCHEMA)
    ids = [r.user_idx for r in serve.user_directory(many).collect()]
    assert ids == list(range(1, config.USER_LIST_CAP + 1))
    assert serve.user_total(many).first().total_users == 250


def test_compact_latest_then_new_batches(spark, tmp):
    b0 = spark.createDataFrame([(1, [(10, 1.0)]), (2, [(20, 2.0)])], SCHEMA)
    write_batch_lists(b0, tmp + "/store", 0)
    serve.compact_latest(store.read_store(spark, tmp + "/store"), tmp + "/compact")
    compact = spark.read.parquet(tmp + "/compact")
    b1 = spark.createDataFrame([(2, [(21, 5.0)])], SCHEMA)
    newer = b1.withColumn("batch_id", F.lit(1).cast("long"))
    both = compact.unionByName(newer)
    got = {r.user_idx: r.recommendations[0].product_idx for r in serve.latest_lists(both).collect()}
    assert got == {1: 10, 2: 21}


def test_point_lookup_is_pushed_down(spark, tmp):
    many = spark.createDataFrame([(u, [(u * 10, 1.0)], 0) for u in range(500)],
                                 SCHEMA + ", batch_id long")
    serve.compact_latest(many, tmp + "/c", files=4)
    compacted = spark.read.parquet(tmp + "/c")
    one = serve.point_lookup(compacted, 321)
    assert [r.recommendations[0].product_idx for r in one.collect()] == [3210]
    plan = spark._jvm.PythonSQLUtils.explainString(one._jdf.queryExecution(), "formatted")
    assert "PushedFilters: [IsNotNull(user_idx), EqualTo(user_idx,321)]" in plan


def test_unknown_total_is_zero_without_ansi(spark, lists):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        req = spark.createDataFrame([(7, 3)], "user_id int, n int")
        assert serve.lookup(req, lists).first().total == 0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_factor_store_reads_the_events_once(spark):
    """The subsets of the second batch come from the written pairs; each use
    scanned and parsed the events before."""
    from ratewise.plans import catalog
    st = catalog.factor_store(spark, SF001)
    files = st.inputFiles()
    assert not any("events.parquet" in f for f in files) and any("ratewise-seen" in f for f in files)
    assert st.where("batch_id = 1").count() > 0
