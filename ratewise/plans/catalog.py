"""The query catalogue: one callable ``(spark, data_dir) -> DataFrame`` per
operator family of the inventory.  Every query reads the driver's tables
(or what Spark derives from them) in full."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise import config
from ratewise.functions import scalars as S
from ratewise.operators import clean, compact, evaluate, report, residuals, serve, split, topk, train
from ratewise.plans import scoring
from ratewise.plans.cleaning import CleaningResult, run_cleaning, with_kept_ratings, write_cleaning
from ratewise.session import materialise
from ratewise.sinks.writers import publish_messages, write_batch_lists, write_record
from ratewise.sources import fixtures, records, store
from ratewise.sources.reviews import read_product_dictionary, read_ratings, read_review_csv, read_user_dictionary
from ratewise.streaming.parse import parse_messages

Query = Callable[[SparkSession, str], DataFrame]


def q_reviews_scan(spark: SparkSession, d: str) -> DataFrame:
    """S-2 / S-3 / P-1 / F-4: the review fixture, four typed columns."""
    return fixtures.reviews(spark, d)


def _stages(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return clean.clean_reviews(fixtures.reviews(spark, d))


def q_dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    """A-5: one row per (user, product), latest Time then higher Score."""
    return _stages(spark, d)["dedup"].select("UserId", "ProductId", "Score", "Time")


def q_user_counts(spark: SparkSession, d: str) -> DataFrame:
    """A-2: reviews per user after dedup."""
    return clean.counts_by(_stages(spark, d)["dedup"], "UserId")


def q_product_counts(spark: SparkSession, d: str) -> DataFrame:
    """A-3: reviews per product after the user filter."""
    return clean.counts_by(_stages(spark, d)["active_users"], "ProductId")


def q_active_users(spark: SparkSession, d: str) -> DataFrame:
    """P-8 / J-1: rows of users with at least 5 reviews."""
    return _stages(spark, d)["active_users"].select("UserId", "ProductId", "Score", "Time")


def q_active_products(spark: SparkSession, d: str) -> DataFrame:
    """J-2: then rows of products with at least 5 reviews."""
    return _stages(spark, d)["active_products"].select("UserId", "ProductId", "Score", "Time")


def q_user_index(spark: SparkSession, d: str) -> DataFrame:
    """R-1 / A-4 / K-2: the user dictionary (dense ids by frequency)."""
    return run_cleaning(fixtures.reviews(spark, d)).users.table


def q_product_index(spark: SparkSession, d: str) -> DataFrame:
    """R-2: the product dictionary."""
    return run_cleaning(fixtures.reviews(spark, d)).products.table


def q_cleaned_ratings(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: the whole cleaning chain -> (user_idx, product_idx, Score)."""
    return run_cleaning(fixtures.reviews(spark, d)).ratings


def q_cleaning_funnel(spark: SparkSession, d: str) -> DataFrame:
    """A-1: row counts of every cleaning stage."""
    return run_cleaning(fixtures.reviews(spark, d)).funnel()


def q_drop_nulls(spark: SparkSession, d: str) -> DataFrame:
    """P-5 / P-6 / P-7: rows with a null or NaN in a rating column removed."""
    gaps = fixtures.reviews_with_gaps(spark, d)
    kept = clean.drop_nulls(gaps, ["UserId", "ProductId", "Score"])
    return clean.require_not_null(kept, ["UserId", "ProductId", "Score"])


def q_typed_casts(spark: SparkSession, d: str) -> DataFrame:
    """P-4 / F-3 / F-4: text fields (some malformed) cast without failing."""
    ev = spark.read.parquet(f"{d}/events.parquet").select("event_id", "ts", "props")
    raw = ev.select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("x"), F.col("event_id").cast("string")))
         .otherwise(((F.col("event_id") % 5) + 1).cast("string")).alias("score_text"),
        F.when(F.col("event_id") % 11 == 0, F.lit("n/a"))
         .otherwise(F.unix_timestamp("ts").cast("string")).alias("time_text"),
        F.col("props").cast("binary").alias("props_bin"))
    return raw.select(
        "event_id",
        S.safe_cast("score_text", "float").alias("Score"),
        S.safe_cast("time_text", "bigint").alias("Time"),
        S.as_text("props_bin").alias("props_text"))


def _ratings(spark: SparkSession, d: str) -> DataFrame:
    return run_cleaning(fixtures.reviews(spark, d)).ratings


def _kept_ratings(spark: SparkSession, d: str) -> DataFrame:
    """``_ratings`` written once, for queries that read them several times."""
    return with_kept_ratings(run_cleaning(fixtures.reviews(spark, d))).ratings


def q_hash_split(spark: SparkSession, d: str) -> DataFrame:
    """M-1: every cleaned rating with its split."""
    return split.assign_split(_ratings(spark, d))


def q_split_counts(spark: SparkSession, d: str) -> DataFrame:
    """M-1: rows per split."""
    return split.split_counts(_ratings(spark, d))


def q_rmse_item_mean(spark: SparkSession, d: str) -> DataFrame:
    """A-6 / A-13 with a fixed predictor: train item mean, scored on the
    validation and test splits; unseen items count as dropped."""
    labelled = split.assign_split(_kept_ratings(spark, d))
    train = labelled.where(F.col("split") == "train")
    table = evaluate.item_mean_predictor(train, 0.0)
    held = labelled.where(F.col("split") != "train")
    pred = evaluate.predict_with(table, held)
    return pred.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("prediction").alias("n_scored"),
        (F.count(F.lit(1)) - F.count("prediction")).alias("n_dropped"),
        F.round(F.sqrt(F.avg(F.pow(F.col("Score").cast("double") - F.col("prediction"), 2))), 6)
         .alias("rmse"))


# --- fixed values: damping of the fixture candidates ------------------------
CANDIDATE_DAMPINGS = (0, 5, 20)
# --- end of fixed values ---------------------------------------------------


def q_candidate_rmse(spark: SparkSession, d: str) -> DataFrame:
    """A-6 / A-7 inputs: validation RMSE of the damped-mean candidates."""
    parts = split.split_frames(_kept_ratings(spark, d))
    return evaluate.candidate_metrics(parts["train"], parts["validation"], CANDIDATE_DAMPINGS)


def q_best_candidate(spark: SparkSession, d: str) -> DataFrame:
    """A-7 then one test evaluation of the chosen candidate (M-6 form);
    every candidate is scored on validation and test in one pass."""
    labelled = split.assign_split(_kept_ratings(spark, d))
    train = labelled.where(F.col("split") == "train")
    held = labelled.where(F.col("split") != "train")
    table = evaluate.candidate_table(train, held, CANDIDATE_DAMPINGS)
    return evaluate.best_with_test(table).select(
        "candidate", "damping", "rmse_validation", "rmse_test")


def q_events_json(spark: SparkSession, d: str) -> DataFrame:
    """F-1: JSON text -> struct field over events.props."""
    ev = spark.read.parquet(f"{d}/events.parquet").select("event_id", "props")
    return ev.select("event_id", S.parse_json("props", "k int")["k"].alias("k"))


def q_json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """K-4 -> F-2 -> bytes -> T-1: what the producer writes parses back."""
    msgs = fixtures.event_messages(spark, d).select(
        "event_id", F.col("value").cast("binary").alias("value"))
    return parse_messages(msgs, keep=("event_id",))


def q_known_event_users(spark: SparkSession, d: str) -> DataFrame:
    """J-3 + A-4: distinct dictionary users among the incoming messages."""
    users = run_cleaning(fixtures.reviews(spark, d)).users
    msgs = parse_messages(fixtures.event_messages(spark, d))
    return users.attach(msgs.select("UserId")).select("UserId", "user_idx").distinct()


def q_topk_all(spark: SparkSession, d: str) -> DataFrame:
    """R-3 / J-6 / F-15: top-5 items of every factor user."""
    users, items = fixtures.factor_fixture(spark, d)
    top = topk.top_k_by_dot(users, items, config.TOP_K, user_out="user_id", item_out="item_id")
    return top.select("user_id", "rank", "item_id", F.round("score", 4).alias("score"))


def q_topk_subset(spark: SparkSession, d: str) -> DataFrame:
    """R-4 / J-5: users requested by the events (duplicates collapse, ids
    without factors give nothing)."""
    users, items = fixtures.factor_fixture(spark, d)
    req = spark.read.parquet(f"{d}/events.parquet").select(
        F.col("user_id").cast("int").alias("user_idx"))
    sub = topk.subset_factors(users, req)
    top = topk.top_k_by_dot(sub, items, config.TOP_K, user_out="user_id", item_out="item_id")
    return top.select("user_id", "rank", "item_id", F.round("score", 4).alias("score"))


def factor_store(spark: SparkSession, d: str) -> DataFrame:
    """A store of two scoring batches over the factor fixture: batch 0
    scores every user over every item; batch 1 re-scores the users seen in
    the events over the products the events name (``50 + props.k``)."""
    users, items = fixtures.factor_fixture(spark, d)
    b0 = topk.top_lists_by_dot(users, items, config.STORE_K)
    ev = spark.read.parquet(f"{d}/events.parquet").select("user_id", "props")
    # the distinct pairs are written once: each subset is counted, measured and read, and
    # would scan and parse the events each time
    seen = materialise(ev.select(F.col("user_id").cast("int").alias("u"),
                                 (S.parse_json("props", "k int")["k"] + F.lit(fixtures.FACTOR_ITEM_SHIFT)).alias("i")
                                 ).distinct(), "seen")
    seen_users, seen_items = (seen.select(F.col(c).alias("user_idx")) for c in ("u", "i"))
    b1 = topk.top_lists_by_dot(topk.subset_factors(users, seen_users), topk.subset_factors(items, seen_items),
                               config.STORE_K)
    return (b0.withColumn("batch_id", F.lit(0).cast("long"))
              .unionByName(b1.withColumn("batch_id", F.lit(1).cast("long"))))


def _latest(spark: SparkSession, d: str) -> DataFrame:
    return serve.latest_lists(factor_store(spark, d))


def q_latest_lists(spark: SparkSession, d: str) -> DataFrame:
    """A-12 / A-11: latest list per user, its batch and size."""
    lists = _latest(spark, d)
    return serve.list_sizes(lists.select("user_idx", "batch_id", "recommendations"),
                            keep=("batch_id",))


def _compacted(spark: SparkSession, d: str) -> tuple[str, str]:
    """The factor store in files, folded twice: batch 0, then the re-scored
    users with an even id; those with an odd id come after that as batch 2."""
    base = scoring.scratch_dir(spark, "compact")
    lists, root = os.path.join(base, "lists"), os.path.join(base, "compacted")
    st = factor_store(spark, d)
    second, odd = F.col("batch_id") == 1, F.col("user_idx") % 2 == 1
    for batch_id, rows in enumerate((st.where(~second), st.where(second & ~odd), st.where(second & odd))):
        write_batch_lists(rows.drop("batch_id"), lists, batch_id)
        if batch_id < 2:
            compact.fold_new(spark, lists, root)
    return lists, root


def q_compacted_lists(spark: SparkSession, d: str) -> DataFrame:
    """K-3 / U-1 / A-12: latest list per user from a store compacted twice
    and one batch that isn't folded yet."""
    lists = compact.current_lists(spark, *_compacted(spark, d))
    return serve.list_sizes(lists.select("user_idx", "batch_id", "recommendations"), keep=("batch_id",))


def q_indexed_lookup(spark: SparkSession, d: str) -> DataFrame:
    """P-9 / V-2: the lookups of ``serve_user`` against a compacted
    generation; only folders of requested users are opened."""
    lists, root = _compacted(spark, d)
    gen = compact.fold_new(spark, lists, root)
    requests = _requests(spark, d)
    return serve.lookup_items(requests, compact.lookup_lists(spark, gen, requests))


def q_point_lookup(spark: SparkSession, d: str) -> DataFrame:
    """P-9: the list of one user, the one with the greatest id."""
    lists, root = _compacted(spark, d)
    gen = compact.fold_new(spark, lists, root)
    last = compact.lists_table(spark, gen).agg(F.max("user_idx").alias("u")).first()["u"]
    row = compact.point_lookup(spark, gen, -1 if last is None else last)
    return train.flat_lists(row).select("user_idx", "rank", "product_idx", F.round(F.col("rating").cast("double"), 4).alias("score"))


def _requests(spark: SparkSession, d: str) -> DataFrame:
    """Lookup requests: every distinct event user, ``n`` varied to cover
    the default (null), values below 1 and above 20."""
    ev = spark.read.parquet(f"{d}/events.parquet").select(F.col("user_id").cast("int").alias("user_id"))
    m = F.col("user_id") % 25
    return ev.distinct().select("user_id", F.when(m == 0, F.lit(None)).otherwise(m - 2)
                                .cast("int").alias("n"))


def q_serve_user(spark: SparkSession, d: str) -> DataFrame:
    """V-2 / P-9 / R-5 / R-6 / F-5 / F-6 / F-8 / F-9 / F-14: lookups, one row per item."""
    return serve.lookup_items(_requests(spark, d), _latest(spark, d))


def q_serve_products(spark: SparkSession, d: str) -> DataFrame:
    """F-6: the lookups with product ids from the saved dictionary."""
    path = write_cleaning(run_cleaning(fixtures.reviews(spark, d)), scoring.scratch_dir(spark, "products"))["products"]
    products = read_product_dictionary(spark, path)
    items = serve.lookup_items(_requests(spark, d), _latest(spark, d))
    return serve.with_product_ids(items, products, products.count()).select("user_id", "pos", "product_idx", "ProductId", "score")


# --- fixed values: which event becomes which kind of store line --------------
LINE_KINDS = ("named", "positional", "pair", "mixed", "blank", "broken", "no user")
# --- end of fixed values ---------------------------------------------------


def _store_line() -> Column:
    """A store line per event, in the encodings and with the faults that the
    store is read with: names, positions, pairs, all mixed, blank, cut short,
    without a user."""
    u, k, v = (F.col(c).cast("string") for c in ("user_id", "k", "score"))

    def text(template: str):
        parts = []
        for piece in re.split(r"(<[ukv]>)", template):
            parts.append({"<u>": u, "<k>": k, "<v>": v}.get(piece, F.lit(piece)))
        return F.concat(*parts)
    lines = {
        "named": '{"user_idx": <u>, "recommendations": [{"product_idx": <k>, "rating": <v>}, {"rating": <v>, "product_idx": 7}]}',
        "positional": '{"user_idx": <u>, "recommendations": [{"0": <k>, "1": <v>}]}',
        "pair": '{"user_idx": <u>, "recommendations": [[<k>, <v>], [8, 1.5, "more"]]}',
        "mixed": '{"user_idx": <u>, "recommendations": [{"x": 1}, [<k>, <v>], "odd", [9], null, {"0": <k>}]}',
        "blank": "   ",
        "broken": '{"user_idx": <u>, "recommendations": [{"product_idx": <k>',
        "no user": '{"recommendations": [[<k>, <v>]]}'}
    out = F.lit(None).cast("string")
    for n, kind in enumerate(LINE_KINDS):
        out = F.when(F.col("event_id") % len(LINE_KINDS) == n, text(lines[kind])).otherwise(out)
    return out


def q_store_encodings(spark: SparkSession, d: str) -> DataFrame:
    """S-6 / F-7 / F-11 / F-13: store files in three encodings, with blank,
    broken and userless lines, one folder per batch; every item read."""
    path = os.path.join(scoring.scratch_dir(spark, "encodings"), "store")
    ev = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "props").select(
        "event_id", "user_id", S.parse_json("props", "k int")["k"].alias("k"), ((F.col("event_id") % 50) / 10).alias("score"))
    # the text writer names files .txt; the store is read by this ending here
    ev.select(_store_line().alias("value"), F.floor(F.col("event_id") / 1000).cast("long").alias("batch_id")).write.partitionBy(
        "batch_id").text(path)
    rows = store.read_store(spark, path, "*.txt")
    return (rows.select("user_idx", "batch_id", F.posexplode("recommendations").alias("pos", "r"))
                .groupBy("user_idx", "batch_id", F.col("pos").cast("int").alias("pos"), F.col("r.product_idx").alias("product_idx"),
                         F.round(F.col("r.rating").cast("double"), 4).alias("score"))
                .agg(F.count(F.lit(1)).alias("n")))


def q_serve_unknown(spark: SparkSession, d: str) -> DataFrame:
    """R-12: unknown requested users with the hint and the user total."""
    return serve.unknown_users(_requests(spark, d), _latest(spark, d))


def q_serve_overview(spark: SparkSession, d: str) -> DataFrame:
    """V-3 / R-9: the first 20 users with their first 5 labels."""
    ov = serve.overview(_latest(spark, d))
    return ov.select("user_idx", "total_users", F.posexplode("top5").alias("pos", "product_id")).select(
        "user_idx", (F.col("pos") + 1).cast("int").alias("pos"), "product_id", "total_users")


def q_serve_users(spark: SparkSession, d: str) -> DataFrame:
    """V-4 / R-8: user ids ascending, first 200."""
    return serve.user_directory(_latest(spark, d))


def q_serve_random(spark: SparkSession, d: str) -> DataFrame:
    """V-6 / R-11: one seeded random user."""
    return serve.random_user(_latest(spark, d))


def q_display_table(spark: SparkSession, d: str) -> DataFrame:
    """V-7 / R-6 / R-7: rank, label, score and bar percent."""
    return serve.display_rows(_latest(spark, d))


def q_user_total(spark: SparkSession, d: str) -> DataFrame:
    """A-9: users with a list."""
    return serve.user_total(_latest(spark, d))


def q_status_row(spark: SparkSession, d: str) -> DataFrame:
    """F-10: files (batches) produced and the run status."""
    store = factor_store(spark, d)
    n = store.agg(F.countDistinct("batch_id").alias("fichiers_generes"))
    return n.select("fichiers_generes", S.run_status(F.col("fichiers_generes")).alias("statut"))


def q_list_sizes_sample(spark: SparkSession, d: str) -> DataFrame:
    """R-10: the report's sample of users with list sizes."""
    return serve.sample_sizes(_latest(spark, d))


# --- model, stream and run-record queries (checked by pytest; rows only) ---

# one configuration for the single-fit queries: the reference's baseline fit
BASE_CONFIG = ((10, 0.1, 10),)
_MEMO: dict = {}


def _cleaned(spark: SparkSession, d: str) -> CleaningResult:
    """The cleaning behind the fits: model, stream and records share its ids."""
    key = (spark.sparkContext.applicationId, d, "cleaned")
    if key not in _MEMO:
        _MEMO[key] = with_kept_ratings(run_cleaning(fixtures.reviews(spark, d)))
    return _MEMO[key]


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    """The cleaned ratings with their split, written once for the fits and what reads a split after them."""
    key = (spark.sparkContext.applicationId, d, "labelled")
    if key not in _MEMO:
        _MEMO[key] = train.labelled_ratings(_cleaned(spark, d).ratings)
    return _MEMO[key]


def _grid(spark: SparkSession, d: str, grid=BASE_CONFIG) -> train.GridResult:
    key = (spark.sparkContext.applicationId, d, grid)
    if key not in _MEMO:
        _MEMO[key] = train.train_labelled(_labelled(spark, d), grid)
    return _MEMO[key]


def q_als_predictions(spark: SparkSession, d: str) -> DataFrame:
    """M-2 / M-3 / M-4: validation ratings with the model's prediction."""
    res = _grid(spark, d)
    val = split.labelled_frames(_labelled(spark, d))["validation"]
    return train.predict(res.model, val).select(
        "user_idx", "product_idx", "Score", F.col("prediction").cast("double").alias("prediction"))


def q_als_grid(spark: SparkSession, d: str) -> DataFrame:
    """M-5 + A-7: validation RMSE of the four configurations, best flagged."""
    res = _grid(spark, d, config.ALS_GRID)
    return res.metrics.withColumn("best", F.col("candidate") == F.lit(res.best["candidate"]))


def q_als_topk(spark: SparkSession, d: str) -> DataFrame:
    """R-3 / J-6 on the fitted factors (blocked scorer)."""
    return train.flat_lists(train.recommend_all(_grid(spark, d).model))


def q_als_scored_keys(spark: SparkSession, d: str) -> DataFrame:
    """M-3 / M-4: the validation ratings that get a prediction, those whose
    user and product are both in train (cold start ``drop``)."""
    return q_als_predictions(spark, d).select("user_idx", "product_idx", "Score")


def q_als_list_shape(spark: SparkSession, d: str) -> DataFrame:
    """R-3 / J-6 on the fitted factors: per train user the size of the list,
    its distinct products and whether the scores descend."""
    lists = train.recommend_all(_grid(spark, d).model)
    scores = F.transform("recommendations", lambda r: r["rating"])
    return lists.select(
        "user_idx", F.size("recommendations").cast("int").alias("n_items"),
        F.size(F.array_distinct(F.transform("recommendations", lambda r: r["product_idx"]))).cast("int").alias("n_distinct"),
        (scores == F.sort_array(scores, asc=False)).alias("ordered"))


def q_als_residuals(spark: SparkSession, d: str) -> DataFrame:
    """M-2 / M-5: per train user, whether its fitted factors solve the normal
    equations of its ratings."""
    parts = split.labelled_frames(_labelled(spark, d))
    rows = residuals.normal_residuals(_grid(spark, d).model, parts["train"], BASE_CONFIG[0][1])
    return rows.select("user_idx", "n_ratings", (F.col("residual") <= residuals.TOLERANCE).alias("solved"))


def _stream_out(spark: SparkSession, d: str) -> str:
    key = (spark.sparkContext.applicationId, d, "stream")
    if key not in _MEMO:
        users = _cleaned(spark, d).users.table
        msgs = fixtures.event_messages(spark, d)
        _MEMO[key] = scoring.run_stream(spark, _grid(spark, d).model, users, msgs)
    return _MEMO[key]


def q_stream_recommendations(spark: SparkSession, d: str) -> DataFrame:
    """T-1..T-7, J-3, K-3, U-1: lists written by the scoring stream over the
    replayed events, latest per user."""
    lists = serve.latest_lists(scoring.read_stream_lists(spark, _stream_out(spark, d)),
                               store.STORE_ORDER)
    return train.flat_lists(lists)


def q_stream_list_sizes(spark: SparkSession, d: str) -> DataFrame:
    """T-2 / A-11 / A-12 over the stream's store: each scored user's latest
    micro-batch and the size of that list."""
    lists = serve.latest_lists(scoring.read_stream_lists(spark, _stream_out(spark, d)), store.STORE_ORDER)
    return serve.list_sizes(lists, keep=("batch_id",))


def q_stream_batches(spark: SparkSession, d: str) -> DataFrame:
    """Per micro-batch: messages received, malformed, known users."""
    return scoring.read_stream_stats(spark, _stream_out(spark, d))


# --- fixed values: which messages are broken, which slice has unknown users only
BROKEN_EVERY = 9
STREAM_SLICES = 4
# --- end of fixed values ---------------------------------------------------


def odd_messages(spark: SparkSession, d: str) -> DataFrame:
    """The event messages with each ``BROKEN_EVERY``-th cut short and users
    that nobody knows in the last slice."""
    msgs = fixtures.event_messages(spark, d)
    top = msgs.agg(F.max("event_id").alias("m")).first()["m"] or 0
    last = F.floor(F.col("event_id") * STREAM_SLICES / F.lit(top + 1)) == STREAM_SLICES - 1
    value = F.when(last, F.replace("value", F.lit('"UserId":"U'), F.lit('"UserId":"X'))).otherwise(F.col("value"))
    cut_short = F.col("event_id") % BROKEN_EVERY == 0
    return msgs.withColumn("value", F.when(cut_short, F.substring("value", 1, 12)).otherwise(value))


def _odd_stream_out(spark: SparkSession, d: str) -> str:
    key = (spark.sparkContext.applicationId, d, "odd stream")
    if key not in _MEMO:
        users = _cleaned(spark, d).users.table
        _MEMO[key] = scoring.run_stream(spark, _grid(spark, d).model, users, odd_messages(spark, d), slices=STREAM_SLICES)
    return _MEMO[key]


def q_stream_odd_batches(spark: SparkSession, d: str) -> DataFrame:
    """A-8 / T-2 / P-10: per micro-batch the messages received, malformed and
    of known users, and the lists stored: none for a batch without known users."""
    out = _odd_stream_out(spark, d)
    stats = scoring.read_stream_stats(spark, out)
    stored = scoring.read_stream_lists(spark, out).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    return stats.join(stored, "batch_id", "left").select(
        "batch_id", "received", "malformed", "known_users", F.col("n").isNotNull().alias("stored"))


def q_model_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """K-5 then S-7: each train user's factors from the saved model are those
    of the fitted one."""
    model = _grid(spark, d).model
    path = os.path.join(scoring.scratch_dir(spark, "model"), "als_model")
    train.save_model(model, path)
    back = train.load_model(path).userFactors.select("id", F.col("features").alias("saved"))
    # both sides have one row per user
    return model.userFactors.join(back, "id", "left").select(
        F.col("id").alias("user_idx"), F.size("features").alias("rank"),
        F.coalesce(F.col("features") == F.col("saved"), F.lit(False)).alias("same"))


def _records(spark: SparkSession, d: str) -> dict[str, str]:
    """Factor-fixture store (two batches) and a metrics record, written
    under the shared checkpoint folder."""
    key = (spark.sparkContext.applicationId, d, "records")
    if key not in _MEMO:
        base = scoring.scratch_dir(spark, "records")
        lists_dir = os.path.join(base, "recommendations")
        st = factor_store(spark, d)
        for b in (0, 1):
            write_batch_lists(st.where(F.col("batch_id") == b).drop("batch_id"), lists_dir, b)
        metrics_dir = os.path.join(base, "metrics")
        write_record(train.metrics_record(_grid(spark, d)), metrics_dir)
        cleaning_paths = write_cleaning(_cleaned(spark, d), base)
        model_dir = os.path.join(base, "als_model")
        train.save_model(_grid(spark, d).model, model_dir)
        report_dir = os.path.join(base, "report")
        write_record(report.run_report(spark, records.read_metrics(spark, metrics_dir),
                                       lists_dir), report_dir)
        _MEMO[key] = {"base": base, "lists": lists_dir, "metrics": metrics_dir,
                        "report": report_dir, "model": model_dir, **cleaning_paths}
    return _MEMO[key]


def q_health(spark: SparkSession, d: str) -> DataFrame:
    """V-1: health row over a written store."""
    return report.health(spark, _records(spark, d)["lists"])


def q_stats(spark: SparkSession, d: str) -> DataFrame:
    """V-5: stats row (users, metrics text, report, model, status)."""
    r = _records(spark, d)
    return report.stats(spark, r["lists"], r["metrics"], r["report"])


def q_run_report(spark: SparkSession, d: str) -> DataFrame:
    """V-9 / F-12 / K-7: the run report, model part read from the metrics record."""
    r = _records(spark, d)
    return report.run_report(spark, records.read_metrics(spark, r["metrics"]), r["lists"])


def q_readiness(spark: SparkSession, d: str) -> DataFrame:
    """V-8: the inputs a scoring run needs, present and counted; the user
    dictionary is included (the stream joins on it)."""
    r = _records(spark, d)
    inputs = {"lineitem": (f"{d}/lineitem.parquet", "parquet"),
              "orders": (f"{d}/orders.parquet", "parquet"),
              "events": (f"{d}/events.parquet", "parquet"),
              "model": (os.path.join(r["model"], "metadata"), "model"),
              "cleaned_ratings": (r["ratings"], "parquet"),
              "user_mapping": (r["users"], "parquet"),
              "metrics": (r["metrics"], "json")}
    return report.readiness(spark, inputs)


# --- sources and sinks exercised on data derived from the tables ---------

CSV_ROWS_PER_FILE = 200_000  # about 25 MB: several blocks a file


def q_record_rows(spark: SparkSession, d: str) -> DataFrame:
    """V-1 / V-5 / V-9 / F-10 / F-12 / K-6 / K-7 / S-8 / S-9 without paths,
    times and fitted numbers: the records over the written store, its
    compacted table, and no store at all."""
    r = _records(spark, d)
    root = os.path.join(scoring.scratch_dir(spark, "records"), "compacted")
    compact.fold_new(spark, r["lists"], root)
    nothing = os.path.join(root, "nothing")
    out = None
    for name, lists, folded, metrics in (("store", r["lists"], None, r["metrics"]), ("compacted", r["lists"], root, r["metrics"]),
                                         ("none", nothing, None, nothing)):
        made = report.run_report(spark, records.read_metrics(spark, metrics), lists, compacted=folded)
        kept = os.path.join(scoring.scratch_dir(spark, "report"), "report")
        write_record(made, kept)
        st = report.stats(spark, lists, metrics, kept, folded)
        h = report.health(spark, lists, folded).first()  # one row of three values
        row = st.select(
            F.lit(name).alias("source"), F.col("total_utilisateurs_avec_recommandations").alias("total"),
            F.col("rmse_info").startswith("Meilleure config").alias("has_metrics"), F.col("statut_pipeline").alias("statut"),
            F.col("rapport_pipeline.pipeline").alias("pipeline"), F.col("modele.algorithme").alias("algorithme"),
            F.col("modele.config.rank").alias("rank"), F.col("modele.config.maxIter").alias("max_iter"),
            F.col("rapport_pipeline.date_execution").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d").alias("dated"),
            F.coalesce(F.concat_ws(",", F.transform("rapport_pipeline.echantillon", lambda x: F.concat_ws(
                ":", x["user_idx"].cast("string"), x["n_items"].cast("string")))), F.lit("")).alias("echantillon"))
        row = row.withColumns({"status": F.lit(h["status"]), "users": F.lit(h["utilisateurs_en_cache"]).cast("long"),
                               "has_files": F.lit(h["fichiers_trouves"] > 0)})
        out = row if out is None else out.unionByName(row)
    return out


def q_readiness_rows(spark: SparkSession, d: str) -> DataFrame:
    """V-8 without paths: inputs present, and the rows of the Parquet ones."""
    return q_readiness(spark, d).select("name", "present", "n_rows")


def q_csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """S-1 / S-2: the reviews written as the review CSV (quoted text with
    commas, doubled quotes, line breaks) in few large files, read back by
    header name, each file by several tasks."""
    path = os.path.join(scoring.scratch_dir(spark, "csv"), "reviews_csv")
    rows = fixtures.review_csv_rows(spark, d)
    files = 1 + spark.read.parquet(f"{d}/lineitem.parquet").count() // CSV_ROWS_PER_FILE
    (rows.repartition(files).write.mode("overwrite")
        .option("header", True).option("escape", '"').csv(path))
    return read_review_csv(spark, path)


def q_ratings_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """K-1 then S-3: cleaned ratings written as Parquet and read back."""
    paths = write_cleaning(run_cleaning(fixtures.reviews(spark, d)),
                           scoring.scratch_dir(spark, "clean"))
    return read_ratings(spark, paths["ratings"])


def q_dictionary_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """K-2 then S-4: the user dictionary written and read back distinct."""
    paths = write_cleaning(run_cleaning(fixtures.reviews(spark, d)),
                           scoring.scratch_dir(spark, "clean"))
    return read_user_dictionary(spark, paths["users"])


def q_message_replay(spark: SparkSession, d: str) -> DataFrame:
    """K-4 then T-1: every review published as one JSON message (text
    sink), read back and parsed."""
    path = os.path.join(scoring.scratch_dir(spark, "messages"), "inbox")
    publish_messages(fixtures.reviews(spark, d), fmt="text", path=path)
    return parse_messages(spark.read.text(path))


def q_pair_scores(spark: SparkSession, d: str) -> DataFrame:
    """J-4 / F-15: (user, item) pairs named by the events scored by factor
    dot product; pairs without factors drop out."""
    users, items = fixtures.factor_fixture(spark, d)
    k = S.parse_json("props", "k int")["k"]
    pairs = spark.read.parquet(f"{d}/events.parquet").select(
        "event_id", F.col("user_id").cast("int").alias("user_idx"),
        (k + F.lit(fixtures.FACTOR_ITEM_SHIFT)).alias("product_idx"))
    scored = topk.score_pairs(pairs, users, items)
    return scored.select("event_id", F.col("user_idx").alias("user_id"),
                         F.col("product_idx").alias("item_id"),
                         F.round("prediction", 4).alias("score"))


def queries() -> dict[str, Query]:
    return {
        "reviews_scan": q_reviews_scan,
        "dedup_latest": q_dedup_latest,
        "user_counts": q_user_counts,
        "product_counts": q_product_counts,
        "active_users": q_active_users,
        "active_products": q_active_products,
        "user_index": q_user_index,
        "product_index": q_product_index,
        "cleaned_ratings": q_cleaned_ratings,
        "cleaning_funnel": q_cleaning_funnel,
        "drop_nulls": q_drop_nulls,
        "typed_casts": q_typed_casts,
        "hash_split": q_hash_split,
        "split_counts": q_split_counts,
        "rmse_item_mean": q_rmse_item_mean,
        "candidate_rmse": q_candidate_rmse,
        "best_candidate": q_best_candidate,
        "events_json": q_events_json,
        "json_roundtrip": q_json_roundtrip,
        "known_event_users": q_known_event_users,
        "topk_all": q_topk_all,
        "topk_subset": q_topk_subset,
        "latest_lists": q_latest_lists,
        "compacted_lists": q_compacted_lists,
        "indexed_lookup": q_indexed_lookup,
        "point_lookup": q_point_lookup,
        "serve_user": q_serve_user,
        "serve_products": q_serve_products,
        "store_encodings": q_store_encodings,
        "serve_unknown": q_serve_unknown,
        "serve_overview": q_serve_overview,
        "serve_users": q_serve_users,
        "serve_random": q_serve_random,
        "display_table": q_display_table,
        "user_total": q_user_total,
        "status_row": q_status_row,
        "list_sizes_sample": q_list_sizes_sample,
        "als_predictions": q_als_predictions,
        "als_scored_keys": q_als_scored_keys,
        "als_list_shape": q_als_list_shape,
        "als_residuals": q_als_residuals,
        "als_grid": q_als_grid,
        "als_topk": q_als_topk,
        "stream_recommendations": q_stream_recommendations,
        "stream_list_sizes": q_stream_list_sizes,
        "stream_batches": q_stream_batches,
        "stream_odd_batches": q_stream_odd_batches,
        "model_roundtrip": q_model_roundtrip,
        "health": q_health,
        "stats": q_stats,
        "run_report": q_run_report,
        "readiness": q_readiness,
        "readiness_rows": q_readiness_rows,
        "record_rows": q_record_rows,
        "csv_scan": q_csv_scan,
        "ratings_roundtrip": q_ratings_roundtrip,
        "dictionary_roundtrip": q_dictionary_roundtrip,
        "message_replay": q_message_replay,
        "pair_scores": q_pair_scores,
    }
