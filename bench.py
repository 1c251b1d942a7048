"""Benchmark of the headline jobs; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Steps (each forced to completion with a real write or the ``noop`` sink):
clean_filter (reviews -> dedup -> user / product filters, written),
dictionaries (both dense indexes), encode_write (ids joined, ratings and
dictionaries written),
funnel, split_eval (hash split + fixed-predictor candidates + choice),
als_grid (4 ALS fits + validation/test RMSE, the reference's training
step), topk_all (top-5 for every user of the chosen model), stream
(scoring stream over the replayed events, 4 micro-batches), serve
(latest lists + lookups + overview over the written store).

A warm-up pass over sf0.001 (``BENCH_WARM_DIR``) runs first and is not
counted: the numbers are steady-state, not JVM / Python-worker start-up.
``BENCH_EVENT_LOG=/tmp/x`` writes Spark's event log to a fresh folder
under it, for stage and task times.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def _sf(sf_dir: str):
    tag = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(tag)
    except ValueError:
        return tag


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import functions as F

    from ratewise.operators import serve, train
    from ratewise.plans import catalog, scoring
    from ratewise.plans.cleaning import CleaningResult, run_cleaning, write_cleaning
    from ratewise.session import local_session
    from ratewise.sources import fixtures, reviews, store

    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        # stage / task times without the UI: Spark's event log in a fresh folder
        log_dir = tempfile.mkdtemp(prefix="bench-events-", dir=os.environ["BENCH_EVENT_LOG"])
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}"}
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, extra=extra)
    base = scoring.scratch_dir(spark, "bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # warm-up, not counted: one pass of every code path over the smallest
    # table set (JIT, class loading, Python workers), so the timings below
    # are steady-state throughput rather than first-call latency
    warm = os.environ.get("BENCH_WARM_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if os.path.isdir(warm):
        wres = run_cleaning(fixtures.reviews(spark, warm))
        wres.funnel().collect()
        catalog.q_best_candidate(spark, warm).collect()
        wgrid = train.train_from_ratings(wres.ratings, ((5, 0.1, 2),))
        _noop(train.recommend_all(wgrid.model))
        scoring.run_stream(spark, wgrid.model, wres.users.table, fixtures.event_messages(spark, warm),
                           slices=1, base=os.path.join(base, "warm"))
    else:
        _noop(spark.read.parquet(f"{sf_dir}/region.parquet"))

    from ratewise.operators import encode
    from ratewise.plans.cleaning import filtered_reviews

    raw = fixtures.reviews(spark, sf_dir)
    n_raw = raw.count()
    stages = timed("clean_filter", lambda: filtered_reviews(raw))
    active = stages["active_products"]
    dicts = timed("dictionaries", lambda: encode.build_dictionaries(active))

    def encode_write():
        users, products = dicts
        ratings = products.attach(users.attach(active)).select(
            "user_idx", "product_idx", F.col("Score").cast("float").alias("Score"))
        return write_cleaning(CleaningResult(stages, ratings, users, products), base)
    paths = timed("encode_write", encode_write)

    timed("funnel", lambda: run_cleaning(fixtures.reviews(spark, sf_dir)).funnel().collect())
    timed("split_eval", lambda: catalog.q_best_candidate(spark, sf_dir).collect())

    ratings = reviews.read_ratings(spark, paths["ratings"])
    grid = timed("als_grid", lambda: train.train_from_ratings(ratings))
    timed("topk_all", lambda: _noop(train.recommend_all(grid.model)))

    users = reviews.read_user_dictionary(spark, paths["users"])
    msgs = fixtures.event_messages(spark, sf_dir)
    out = timed("stream", lambda: scoring.run_stream(
        spark, grid.model, users, msgs, slices=4, base=os.path.join(base, "stream")))

    def serving():
        lists = serve.latest_lists(scoring.read_stream_lists(spark, out), store.STORE_ORDER).cache()
        req = spark.read.parquet(f"{sf_dir}/events.parquet").select(
            F.col("user_id").cast("int").alias("user_id")).distinct().withColumn("n", F.lit(None).cast("int"))
        _noop(serve.lookup(req, lists))
        serve.overview(lists).collect()
        serve.user_directory(lists).collect()
        serve.user_total(lists).collect()
        lists.unpersist()
    timed("serve", serving)

    n_msgs = msgs.count()
    n_ratings = ratings.count()
    total = round(sum(times.values()), 3)
    clean_sec = times["clean_filter"] + times["dictionaries"] + times["encode_write"]
    print(json.dumps({"metric": "end_to_end_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": _sf(sf_dir),
                      "cpus": int(cpus), "spark": spark.version, "warm_up": os.path.isdir(warm),
                      "rows": {"raw_reviews": n_raw, "cleaned": n_ratings, "messages": n_msgs},
                      "throughput": {
                          "clean_rows_per_sec": round(n_raw / clean_sec, 1),
                          "stream_msgs_per_sec": round(n_msgs / times["stream"], 1),
                          "als_grid_ratings_per_sec": round(n_ratings / times["als_grid"], 1)},
                      "best_config": {k: grid.best[k] for k in ("rank", "regParam", "maxIter")},
                      "rmse_validation": round(grid.best["rmse_validation"], 4),
                      "rmse_test": round(grid.rmse_test, 4)}))
    spark.stop()


if __name__ == "__main__":
    main()
