"""Command-line jobs (run with ``spark-submit`` or ``python -m ratewise``).

    clean   --csv reviews.csv --out DIR          cleaned ratings + dictionaries
    train   --ratings DIR/cleaned_reviews.parquet --out DIR
                                                 grid-selected model, metrics, lists
    stream  --model DIR --users DIR/user_mapping.parquet --out DIR --checkpoint DIR
            (--path INBOX [--files-per-batch N] [--bytes-per-batch N]
             | --kafka HOST:PORT [--topic T] [--starting earliest]
               [--offsets-per-batch N] [--least-offsets N [--longest-delay 5m]])
            [--available-now | --seconds N]      scoring stream
    compact --store DIR --out DIR                latest list per user, sorted by user
    fold    --store DIR --out DIR                folds new batches into an indexed table of these
    report  --store DIR --metrics DIR --out DIR [--broker B]
                                                 run report record
    check   NAME=PATH:KIND ...                   readiness table; fails on a missing input

The session comes from the launcher (master, memory, ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from ratewise import config


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("ratewise").getOrCreate()
    from ratewise.session import checkpoint_dir
    checkpoint_dir(spark)
    return spark


def cmd_clean(spark: SparkSession, a) -> None:
    from ratewise.plans.cleaning import run_cleaning, write_cleaning
    from ratewise.sources.reviews import read_review_csv
    res = run_cleaning(read_review_csv(spark, a.csv, multiline=not a.single_line))
    paths = write_cleaning(res, a.out)
    res.funnel().coalesce(1).write.mode("overwrite").json(os.path.join(a.out, "funnel"))
    print(paths)


def cmd_train(spark: SparkSession, a) -> None:
    from ratewise.plans.training import run_training, write_training
    from ratewise.sources.reviews import read_ratings
    out = run_training(read_ratings(spark, a.ratings))
    print(write_training(out, a.out))


def cmd_stream(spark: SparkSession, a) -> None:
    from ratewise.operators.train import load_model
    from ratewise.sources.reviews import read_user_dictionary
    from ratewise.streaming.scoring import (BatchScorer, SourceConfig, kafka_source,
                                            run_bounded, start_scoring)
    if a.kafka:
        src = kafka_source(a.kafka, a.topic, a.starting).limited(
            offsets=a.offsets_per_batch, least_offsets=a.least_offsets, longest_delay=a.longest_delay)
    else:
        src = SourceConfig(format="text", path=a.path).limited(files=a.files_per_batch, size=a.bytes_per_batch)
    scorer = BatchScorer(load_model(a.model), read_user_dictionary(spark, a.users), a.out)
    trigger = {"availableNow": True} if a.available_now else None
    q = start_scoring(spark, src, scorer, a.checkpoint, trigger=trigger)
    try:
        if a.available_now:
            q.awaitTermination()
        else:
            run_bounded(q, a.seconds)
    finally:
        scorer.close()


def cmd_compact(spark: SparkSession, a) -> None:
    from ratewise.operators.serve import compact_latest
    from ratewise.sources import store
    compact_latest(store.read_store(spark, a.store), a.out, store.STORE_ORDER)


def cmd_fold(spark: SparkSession, a) -> None:
    from ratewise.operators.compact import fold_new
    print(fold_new(spark, a.store, a.out))


def cmd_report(spark: SparkSession, a) -> None:
    from ratewise.operators.report import run_report
    from ratewise.sinks.writers import write_record
    from ratewise.sources.records import read_metrics
    write_record(run_report(spark, read_metrics(spark, a.metrics), a.store, a.broker), a.out)


def cmd_check(spark: SparkSession, a) -> None:
    from ratewise.operators.report import readiness
    inputs = {}
    for item in a.inputs:
        name, rest = item.split("=", 1)
        path, _, kind = rest.rpartition(":")
        inputs[name] = (path, kind or "parquet")
    readiness(spark, inputs).show(truncate=False)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ratewise")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--csv", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--single-line", action="store_true",
                   help="the CSV has no quoted line breaks: read it as splittable lines")
    t = sub.add_parser("train")
    t.add_argument("--ratings", required=True)
    t.add_argument("--out", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--model", required=True)
    s.add_argument("--users", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--path")
    s.add_argument("--kafka")
    s.add_argument("--topic", default="reviews_stream")
    s.add_argument("--starting", default="latest")
    s.add_argument("--files-per-batch", type=int)
    s.add_argument("--bytes-per-batch")
    s.add_argument("--offsets-per-batch", type=int, default=config.STREAM_OFFSETS_PER_BATCH)
    s.add_argument("--least-offsets", type=int)
    s.add_argument("--longest-delay")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--seconds", type=float, default=None)
    k = sub.add_parser("compact")
    k.add_argument("--store", required=True)
    k.add_argument("--out", required=True)
    fo = sub.add_parser("fold")
    fo.add_argument("--store", required=True)
    fo.add_argument("--out", required=True)
    r = sub.add_parser("report")
    r.add_argument("--store", required=True)
    r.add_argument("--metrics", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--broker", default="")
    ch = sub.add_parser("check")
    ch.add_argument("inputs", nargs="+")
    return p


COMMANDS = {"clean": cmd_clean, "train": cmd_train, "stream": cmd_stream,
            "compact": cmd_compact, "fold": cmd_fold, "report": cmd_report, "check": cmd_check}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    if a.cmd == "stream" and not (a.path or a.kafka):
        raise SystemExit("stream needs --path or --kafka")
    COMMANDS[a.cmd](spark or _session(), a)


if __name__ == "__main__":
    main(sys.argv[1:])
