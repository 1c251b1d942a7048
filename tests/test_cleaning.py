"""Cleaning chain: dedup rule, filter order, dense index, funnel."""

import os

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from conftest import SF001
from ratewise.operators import clean, encode
from ratewise.plans.cleaning import run_cleaning, write_cleaning
from ratewise.sources import fixtures, reviews


def test_dedup_latest_time_then_score(spark):
    df = spark.createDataFrame(
        [("u", "p", 1.0, 10), ("u", "p", 4.0, 20), ("u", "p", 2.0, 20),
         ("v", "p", 3.0, None), ("v", "p", 5.0, None), ("w", "q", 2.0, 5)],
        "UserId string, ProductId string, Score float, Time long")
    out = {(r.UserId, r.ProductId): (r.Score, r.Time) for r in clean.dedup_latest(df).collect()}
    assert out[("u", "p")] == (4.0, 20)      # latest time, then higher score
    assert out[("v", "p")] == (5.0, None)    # no time: higher score
    assert out[("w", "q")] == (2.0, 5)


def test_drop_nulls_removes_nan(spark):
    df = spark.createDataFrame(
        [("u", "p", float("nan")), ("u", None, 1.0), ("u", "p", 2.0)],
        "UserId string, ProductId string, Score float")
    assert clean.drop_nulls(df).count() == 1


def test_filter_order_users_then_products(spark):
    # user a has 5 reviews, but after the product filter only 1 remains:
    # the chain runs once and does not iterate
    rows = [("a", f"p{i}", 1.0, 0) for i in range(5)]
    rows += [(f"u{j}", "p0", 1.0, 0) for j in range(4)]
    rows += [(f"u{j}", f"x{k}", 1.0, 0) for j in range(4) for k in range(4)]
    df = spark.createDataFrame(rows, "UserId string, ProductId string, Score float, Time long")
    st = clean.clean_reviews(df)
    users_left = st["active_users"].select("UserId").distinct().count()
    assert users_left == 5
    final = st["active_products"]
    assert final.where("UserId = 'a'").count() == 1  # only p0 kept, user stays


def test_funnel_matches_fixture_counts(spark):
    res = run_cleaning(fixtures.reviews(spark, SF001))
    f = {r.stage: r.n_rows for r in res.funnel().collect()}
    assert f == {"raw": 6000, "non_null": 6000, "dedup": 5889, "active_users": 5146,
                 "active_products": 3169, "final": 3169}
    assert res.users.size == 635 and res.products.size == 508


def test_funnel_reads_the_raw_reviews_once(spark, tmp):
    """The input is gone after the chain ran; every count is still there."""
    from ratewise.session import remove_path
    rows = [(None, "p", 1.0, 1)] * 7 + [("u", None, 1.0, 1), ("u", "p", float("nan"), 1), ("u", "p", None, 1)]
    rows += [(f"u{i % 4}", f"p{i % 8}", 1.0 + i % 5, i) for i in range(60)] + [("lone", "p0", 2.0, None)] * 3
    path = tmp + "/raw"
    spark.createDataFrame(rows, "UserId string, ProductId string, Score float, Time long").repartition(4).write.parquet(path)
    plain = clean.clean_reviews(spark.read.parquet(path))
    want = {r.stage: r.n_rows for r in clean.funnel(plain).collect()}
    same = sorted(map(tuple, plain["dedup"].select("UserId", "ProductId", "Score", "Time").collect()), key=str)
    res = run_cleaning(spark.read.parquet(path))
    remove_path(spark, path)
    got = {r.stage: r.n_rows for r in res.funnel().collect()}
    assert got.pop("final") == got["active_products"]
    assert got == want and got["raw"] == len(rows) and got["non_null"] == len(rows) - 10
    assert sorted(map(tuple, res.stages["dedup"].collect()), key=str) == same


def test_dedup_plan_scans_and_shuffles_once(spark):
    counted = clean.dedup_counted(fixtures.reviews(spark, SF001))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("Exchange hashpartitioning(UserId") <= 1


def test_index_equals_string_indexer(spark):
    res = run_cleaning(fixtures.reviews(spark, SF001))
    active = res.stages["active_products"]
    for col, idx, d in (("UserId", "user_idx", res.users), ("ProductId", "product_idx", res.products)):
        model = StringIndexer(inputCol=col, outputCol="ref").fit(active)
        ref = model.transform(active.select(col).distinct()).select(col, F.col("ref").cast("int"))
        mine = d.table
        diff = ref.join(mine, col).where(F.col("ref") != F.col(idx)).count()
        assert diff == 0
        assert mine.count() == ref.count()


@pytest.mark.parametrize("literal_max", [1024, 2])
def test_index_dense_across_partitions(spark, monkeypatch, literal_max):
    # many partitions in the sort: ids must still be 0..n-1 without gaps,
    # with the offsets as a literal array or as a broadcast table
    monkeypatch.setattr(encode, "_LITERAL_OFFSETS_MAX", literal_max)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 5000).select(
            (F.col("id") % 997).cast("string").alias("k"))
        d = encode.frequency_index(df, "k", "k_idx")
        got = d.table.agg(F.min("k_idx"), F.max("k_idx"), F.countDistinct("k_idx")).first()
        assert tuple(got) == (0, 996, 997)
        assert d.size == 997
        # most frequent labels first (ids 0..14 have 6 rows, the rest 5)
        top = {r.k for r in d.table.where("k_idx < 15").collect()}
        assert top == {str(i) for i in range(15)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_write_and_read_back(spark, tmp):
    res = run_cleaning(fixtures.reviews(spark, SF001))
    paths = write_cleaning(res, tmp)
    back = reviews.read_ratings(spark, paths["ratings"])
    assert back.schema.simpleString() == "struct<user_idx:int,product_idx:int,Score:float>"
    assert back.exceptAll(res.ratings).count() == 0 and back.count() == 3169
    users = reviews.read_user_dictionary(spark, paths["users"])
    assert users.count() == 635
    prods = reviews.read_product_dictionary(spark, paths["products"])
    assert prods.count() == 508


@pytest.mark.parametrize("hot_rows,broadcast_max", [(10**6, 10**6), (100, 10**6), (100, 10)])
def test_hot_user_third_of_rows(spark, monkeypatch, hot_rows, broadcast_max):
    """One user holds a third of all rows (and repeats pairs): the chain
    stays exact against a plain recomputation, with and without the hot-key
    split (small ``hot_rows``) and the split dictionary join (tiny
    broadcast limit)."""
    from ratewise import config
    monkeypatch.setattr(config, "BROADCAST_MAX_ROWS", broadcast_max)
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        rows.append(("HOT", f"p{rnd.randrange(400)}", float(rnd.randrange(1, 6)), rnd.randrange(50)))
    for i in range(6000):
        rows.append((f"u{rnd.randrange(900)}", f"p{rnd.randrange(400)}",
                     float(rnd.randrange(1, 6)), rnd.randrange(50)))
    df = spark.createDataFrame(rows, "UserId string, ProductId string, Score float, Time long")
    res = run_cleaning(df, hot_rows=hot_rows)
    # plain recomputation
    best = {}
    for u, p, s, t in rows:
        k = (u, p)
        if k not in best or (t, s) > best[k]:
            best[k] = (t, s)
    from collections import Counter
    uc = Counter(u for u, _ in best)
    kept = {k: v for k, v in best.items() if uc[k[0]] >= 5}
    pc = Counter(p for _, p in kept)
    kept = {k: v for k, v in kept.items() if pc[k[1]] >= 5}
    fu = Counter(u for u, _ in kept)
    fp = Counter(p for _, p in kept)
    uidx = {u: i for i, u in enumerate(sorted(fu, key=lambda u: (-fu[u], u)))}
    pidx = {p: i for i, p in enumerate(sorted(fp, key=lambda p: (-fp[p], p)))}
    want = sorted((uidx[u], pidx[p], v[1]) for (u, p), v in kept.items())
    got = sorted((r.user_idx, r.product_idx, r.Score) for r in res.ratings.collect())
    assert got == want
    assert uidx["HOT"] == 0


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_shuffles_of_a_written_stage_go(spark):
    """What made the written stages isn't on disk when the ratings are."""
    import time

    from ratewise.plans.cleaning import filtered_reviews, with_kept_ratings
    before = _shuffle_files(spark)
    stages = filtered_reviews(fixtures.reviews(spark, SF001))
    made = _shuffle_files(spark) - before
    kept = with_kept_ratings(run_cleaning(fixtures.reviews(spark, SF001)))
    for _ in range(50):  # Spark's cleaner runs beside
        if not _shuffle_files(spark) & made:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) & made
    assert stages["dedup"].count() >= kept.ratings.count() > 0


def test_kept_ratings_need_no_written_stage(spark):
    from ratewise.plans.cleaning import with_kept_ratings
    res = run_cleaning(fixtures.reviews(spark, SF001))
    folders = {os.path.dirname(f).removeprefix("file://") for s in ("counted", "active_products") for f in res.stages[s].inputFiles()}
    rows = sorted(map(tuple, res.ratings.collect()))
    kept = with_kept_ratings(res)
    assert len(folders) == 2 and not any(os.path.exists(f) for f in folders)
    assert sorted(map(tuple, kept.ratings.collect())) == rows
    assert kept.users.table.count() == kept.users.size > 0 and kept.products.table.count() == kept.products.size > 0


def test_dedup_buffer_holds_time_and_score_once(spark):
    """One buffer per pair in the shuffle, with the rows of the plain dedup."""
    rows = [("u", "p", 1.0, 10), ("u", "p", 4.0, 20), ("u", "p", 2.0, 20), ("u", "p", 5.0, None),
            ("v", "p", 3.0, None), ("v", "p", 5.0, None), ("w", "q", 2.0, 5), ("w", "q", 2.0, 5), (None, "q", 1.0, 9)]
    df = spark.createDataFrame(rows, "UserId string, ProductId string, Score float, Time long")
    counted = clean.dedup_counted(df)
    assert counted.schema.simpleString() == "struct<UserId:string,ProductId:string,Score:float,Time:bigint,n_rows:bigint>"
    got = sorted(map(tuple, counted.collect()), key=str)
    assert got == sorted([("u", "p", 4.0, 20, 4), ("v", "p", 5.0, None, 2), ("w", "q", 2.0, 5, 2), (None, None, None, None, 1)], key=str)
    plain = clean.dedup_latest(df.where("UserId is not null")).select("UserId", "ProductId", "Score", "Time").collect()
    assert sorted(map(tuple, plain), key=str) == sorted((r[:4] for r in got if r[0]), key=str)
    plan = clean.dedup_counted(df)._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan and plan.count("partial_max(") == 1


def test_active_users_are_joined_once(spark):
    """The product counts and the product filter read the written rows of active
    users; no row carries the time, which nothing reads after the dedup."""
    from ratewise.plans.cleaning import filtered_reviews
    stages = filtered_reviews(fixtures.reviews(spark, SF001))
    plain = clean.clean_reviews(fixtures.reviews(spark, SF001))
    for name in ("active_users", "active_products"):
        plan = stages[name]._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "Join" not in plan and "Exchange" not in plan
        assert sorted(stages[name].columns) == ["ProductId", "Score", "UserId"]
        want = sorted(map(tuple, plain[name].select("UserId", "ProductId", "Score").collect()))
        assert sorted(map(tuple, stages[name].select("UserId", "ProductId", "Score").collect())) == want and want


def test_kept_ratings_leave_no_active_users(spark):
    from ratewise.plans.cleaning import with_kept_ratings
    res = run_cleaning(fixtures.reviews(spark, SF001))
    folders = {os.path.dirname(f).removeprefix("file://") for f in res.stages["active_users"].inputFiles()}
    assert with_kept_ratings(res).ratings.count() == 3169
    assert len(folders) == 1 and not any(os.path.exists(f) for f in folders)


def test_reviews_join_shuffles_what_a_line_gives(spark):
    """Flags and residue are made on the line items' side, below the join."""
    plan = fixtures.reviews(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join Inner"):]
    assert "AS flags" in below and "AS residue" in below
