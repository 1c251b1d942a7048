"""Blocked top-k scorer against brute force."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from ratewise.operators import pruned, topk
from ratewise.sources import fixtures


def _brute(users, items, k):
    out = {}
    for uid, uv in users:
        scores = [(float(np.dot(np.asarray(uv, np.float64), np.asarray(iv, np.float64))), iid)
                  for iid, iv in items]
        scores.sort(key=lambda t: (-t[0], t[1]))
        out[uid] = [(iid, s) for s, iid in scores[:k]]
    return out


def _check(spark, users_df, items_df, k, **kw):
    got = topk.top_k_by_dot(users_df, items_df, k, **kw).collect()
    users = [(r.id, r.features) for r in users_df.collect()]
    items = [(r.id, r.features) for r in items_df.collect()]
    ref = _brute(users, items, k)
    mine = {}
    for r in sorted(got, key=lambda r: (r.user, r.rank)):
        mine.setdefault(r.user, []).append((r.item, r.score))
    assert set(mine) == set(ref)
    for u in ref:
        assert [i for i, _ in mine[u]] == [i for i, _ in ref[u]]
        assert np.allclose([s for _, s in mine[u]], [s for _, s in ref[u]], rtol=1e-9)


def test_single_block_matches_brute_force(spark):
    users, items = fixtures.factor_fixture(spark, SF001)
    _check(spark, users, items, 5)
    _check(spark, users, items, 5, broadcast_bytes=-1)


def test_many_blocks_match_brute_force(spark):
    users, items = fixtures.factor_fixture(spark, SF001)
    # 7-row blocks: 8 user blocks x 65 item blocks, merged per user
    _check(spark, users, items, 5, block_rows=7, broadcast_bytes=-1)


def test_items_beyond_the_limit_are_not_sent_to_every_user_block(spark):
    """One shuffle, of the users; an item is in one file, files by falling norm."""
    users, items = fixtures.factor_fixture(spark, SF001)
    found = topk.top_k_by_dot(users, items, 5, block_rows=7, broadcast_bytes=-1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Generate" not in plan and "CoGroup" not in plan
    files = topk.write_items(items, items.count(), 50)
    norms = {r._i: float(np.linalg.norm(np.array(r._v, np.float64))) for r in files.table(spark).collect()}
    assert sorted(norms) == sorted(r.id for r in items.collect()) and files.n_items == len(norms)
    tops = [top for _, top in files.files]
    assert len(tops) > 3 and tops == sorted(tops, reverse=True) and np.isclose(tops[0], max(norms.values()))


def test_running_search_equals_one_index():
    """Ties, zeros and fewer items than k, whatever the cut into indexes."""
    rng = np.random.default_rng(8)
    vectors = rng.integers(-2, 3, (150, 3)).astype(float)
    users = np.vstack([rng.integers(-2, 3, (40, 3)), np.zeros((1, 3))]).astype(float)
    ids, norms = rng.permutation(1000)[:150], np.linalg.norm(vectors, axis=1)
    order = np.argsort(-norms, kind="stable")
    for k, size in ((1, 4), (7, 20), (150, 40)):
        search = pruned.RunningSearch(users, k)
        for part in np.array_split(order, len(order) // size):
            if not search.going(norms[part].max()):
                break
            search.add(pruned.ItemIndex(ids[part], vectors[part], block=8))
        want_ids, want = _exact(users, ids, vectors, k)
        assert search.ids.tolist() == want_ids.tolist() and search.scores.tolist() == want.tolist()


def _exact(users, ids, vectors, k):
    s = users @ vectors.T
    order = np.lexsort((np.broadcast_to(ids, s.shape), -s), axis=1)[:, :k]
    return ids[order], np.take_along_axis(s, order, axis=1)


def test_search_skips_blocks_and_stays_exact():
    """Long-tailed norms: most blocks are never scored, no list changes."""
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(5000, 12)) * (1 / (1 + np.arange(5000)))[:, None] ** 0.7
    ids, users = rng.permutation(5000), rng.normal(size=(300, 12))
    work = {}
    got_ids, got = pruned.ItemIndex(ids, vectors, block=64).search(users, 7, work)
    want_ids, want = _exact(users, ids, vectors, 7)
    assert got_ids.tolist() == want_ids.tolist() and np.allclose(got, want, rtol=1e-12)
    assert work["scored"] + work["skipped"] == 300 * 79 and work["skipped"] > 0.8 * 300 * 79


def test_search_with_ties_zeros_and_negative_scores():
    """Integers make scores exact: ties across blocks go to the lower id."""
    rng = np.random.default_rng(7)
    for k in (1, 3, 20, 200):
        vectors = rng.integers(-2, 3, (150, 3)).astype(float)
        users = np.vstack([rng.integers(-2, 3, (40, 3)), np.zeros((1, 3))]).astype(float)
        ids = rng.permutation(1000)[:150]
        got_ids, got = pruned.ItemIndex(ids, vectors, block=8).search(users, k)
        want_ids, want = _exact(users, ids, vectors, k)
        assert got_ids.tolist() == want_ids.tolist() and got.tolist() == want.tolist()


def test_search_skips_blocks_that_point_elsewhere():
    """Items of one norm: only their directions tell blocks apart."""
    rng = np.random.default_rng(8)
    vectors, users = rng.normal(size=(20000, 4)), rng.normal(size=(500, 4)).astype(np.float32).astype(float)
    vectors = (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32).astype(float)
    ids = rng.permutation(20000)
    want_ids, want = _exact(users, ids, vectors, 5)
    work = {}
    got_ids, got = pruned.ItemIndex(ids, vectors, block=64).search(users, 5, work)
    assert got_ids.tolist() == want_ids.tolist() and np.allclose(got, want, rtol=1e-12)
    assert work["scored"] + work["skipped"] == 500 * 313 and work["skipped"] > 0.7 * 500 * 313
    whole = pruned.ItemIndex(ids, vectors, block=64, first_band=pruned.LARGEST_BAND, split=False)
    assert whole.search(users, 5)[0].tolist() == want_ids.tolist()


def test_search_tells_scores_apart_that_32_bits_do_not():
    rng = np.random.default_rng(9)
    users = np.abs(rng.normal(size=(50, 3)))
    for scale in (1.0, 1e-30, 1e30):  # small and large numbers leave the range of 32 bits
        vectors = scale * (1 + rng.permutation(3000)[:, None] * 1e-10) * np.ones((3000, 3))
        ids = rng.permutation(3000)
        want_ids, _ = _exact(users, ids, vectors, 6)
        got_ids, _ = pruned.ItemIndex(ids, vectors, block=16).search(users, 6)
        assert got_ids.tolist() == want_ids.tolist()


def test_no_shuffle_while_items_fit(spark):
    users, items = fixtures.factor_fixture(spark, SF001)
    for df in (topk.top_k_by_dot(users, items, 5), topk.top_lists_by_dot(users, items, 5)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    blocked = topk.top_lists_by_dot(users, items, 5, broadcast_bytes=-1)
    assert "Exchange" in blocked._jdf.queryExecution().executedPlan().toString()
    direct = topk.top_lists_by_dot(users, items, 5)
    assert direct.schema.simpleString() == blocked.schema.simpleString()
    assert sorted(map(str, direct.collect())) == sorted(map(str, blocked.collect()))


def test_ties_go_to_lower_item_id(spark):
    users = spark.createDataFrame([(1, [1.0, 0.0])], "id int, features array<float>")
    items = spark.createDataFrame(
        [(i, [1.0, float(i % 2)]) for i in range(10, 0, -1)], "id int, features array<float>")
    got = topk.top_k_by_dot(users, items, 3, block_rows=4, broadcast_bytes=-1).orderBy("rank").collect()
    assert [r.item for r in got] == [1, 2, 3]
    got = topk.top_k_by_dot(users, items, 3).orderBy("rank").collect()
    assert [r.item for r in got] == [1, 2, 3]


def test_fewer_items_than_k(spark):
    users = spark.createDataFrame([(1, [1.0]), (2, [-1.0])], "id int, features array<float>")
    items = spark.createDataFrame([(5, [2.0]), (6, [1.0])], "id int, features array<float>")
    got = {(r.user, r.rank): r.item for r in topk.top_k_by_dot(users, items, 5).collect()}
    assert got == {(1, 1): 5, (1, 2): 6, (2, 1): 6, (2, 2): 5}


def test_subset_collapses_and_skips_unknown(spark):
    users, items = fixtures.factor_fixture(spark, SF001)
    req = spark.createDataFrame([(3,), (3,), (7,), (4242,)], "user_idx int")
    sub = topk.subset_factors(users, req)
    assert sorted(r.id for r in sub.collect()) == [3, 7]
    lists = topk.as_lists(topk.top_k_by_dot(sub, items, 5, user_out="user_idx",
                                            item_out="product_idx"))
    rows = lists.collect()
    assert len(rows) == 2
    for r in rows:
        ratings = [e.rating for e in r.recommendations]
        assert len(ratings) == 5 and ratings == sorted(ratings, reverse=True)
        assert len({e.product_idx for e in r.recommendations}) == 5


def test_list_schema(spark):
    users, items = fixtures.factor_fixture(spark, SF001)
    lists = topk.as_lists(topk.top_k_by_dot(users.where(F.col("id") < 3), items, 5,
                                            user_out="user_idx", item_out="product_idx"))
    assert lists.schema.simpleString() == \
        "struct<user_idx:int,recommendations:array<struct<product_idx:int,rating:float>>>"


def test_prepared_items_match_general_path(spark):
    users, items = fixtures.factor_fixture(spark, SF001)
    small = topk.prepare_items(items)
    prep = topk.prepare_items(items, block_rows=100, partitions=5, broadcast_bytes=-1)
    try:
        a = {(r.user, r.rank): (r.item, round(r.score, 9))
             for r in topk.top_k_prepared(users, prep, 5).collect()}
        b = {(r.user, r.rank): (r.item, round(r.score, 9))
             for r in topk.top_k_by_dot(users, items, 5, block_rows=100, broadcast_bytes=-1).collect()}
        assert a == b
        assert b == {(r.user, r.rank): (r.item, round(r.score, 9)) for r in topk.top_k_prepared(users, small, 5).collect()}
        assert sorted(map(str, topk.lists_prepared(users, small, 5).collect())) == sorted(
            map(str, topk.lists_prepared(users, prep, 5).collect()))
        # more users than one block: falls back to the general path
        c = {(r.user, r.rank): (r.item, round(r.score, 9))
             for r in topk.top_k_prepared(users, topk.PreparedItems(
                 prep.table, prep.n_items, prep.nb_i, block_rows=7), 5).collect()}
        assert c == b
    finally:
        prep.release()
        small.release()
