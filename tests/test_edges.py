"""Empty inputs flow through every stage without failing."""

from ratewise.operators import serve, topk
from ratewise.plans.cleaning import run_cleaning

REVIEW = "UserId string, ProductId string, Score float, Time long"
LISTS = "user_idx int, recommendations array<struct<product_idx:int,rating:float>>"


def test_empty_reviews(spark):
    res = run_cleaning(spark.createDataFrame([], REVIEW))
    assert res.ratings.count() == 0
    assert res.users.size == 0 and res.products.size == 0
    assert {r.stage: r.n_rows for r in res.funnel().collect()}["final"] == 0


def test_all_users_below_threshold(spark):
    rows = [(f"u{i}", f"p{i % 3}", 1.0, i) for i in range(20)]  # one review per user
    res = run_cleaning(spark.createDataFrame(rows, REVIEW))
    assert res.ratings.count() == 0


def test_topk_empty_sides(spark):
    vec = "id int, features array<float>"
    users = spark.createDataFrame([(1, [1.0, 2.0])], vec)
    none = spark.createDataFrame([], vec)
    assert topk.top_k_by_dot(none, users, 5).count() == 0
    assert topk.top_k_by_dot(users, none, 5).count() == 0
    assert topk.as_lists(topk.top_k_by_dot(none, users, 5, user_out="user_idx",
                                           item_out="product_idx")).count() == 0


def test_serving_on_empty_store(spark):
    lists = spark.createDataFrame([], LISTS)
    req = spark.createDataFrame([(1, None)], "user_id int, n int")
    r = serve.lookup(req, lists).first()
    assert r.status == "unknown" and r.total == 0
    u = serve.unknown_users(req, lists).first()
    assert u.hint == "" and u.total_users == 0
    assert serve.overview(lists).count() == 0
    assert serve.user_total(lists).first().total_users == 0
    assert serve.random_user(lists).count() == 0
