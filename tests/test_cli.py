"""The job CLI end to end: CSV -> clean -> train -> stream -> compact -> report."""

import os

from conftest import SF001
from ratewise.__main__ import main
from ratewise.sources import fixtures, store


def test_jobs_end_to_end(spark, tmp):
    csv = os.path.join(tmp, "reviews_csv")
    (fixtures.review_csv_rows(spark, SF001).write.mode("overwrite")
        .option("header", True).option("escape", '"').csv(csv))
    data = os.path.join(tmp, "data")
    main(["clean", "--csv", csv, "--out", data], spark)
    assert spark.read.parquet(os.path.join(data, "cleaned_reviews.parquet")).count() == 3169
    funnel = {r.stage: r.n_rows for r in spark.read.json(os.path.join(data, "funnel")).collect()}
    assert funnel["raw"] == 6000 and funnel["final"] == 3169

    model_dir = os.path.join(tmp, "model")
    main(["train", "--ratings", os.path.join(data, "cleaned_reviews.parquet"), "--out", model_dir], spark)
    metrics = spark.read.json(os.path.join(model_dir, "metrics")).first()
    assert metrics.config.rank in (5, 10, 15, 20)
    lines = [r.value for r in spark.read.text(os.path.join(model_dir, "metrics_text")).collect()]
    assert len(lines) == 3 and lines[0].startswith("Meilleure config : {'rank': ")
    assert lines[1] == f"RMSE validation  : {metrics.rmse_validation:.4f}"

    inbox = os.path.join(tmp, "inbox")
    fixtures.event_messages(spark, SF001).select("value").repartition(2).write.text(inbox)
    out = os.path.join(tmp, "out")
    main(["stream", "--model", os.path.join(model_dir, "als_model"),
          "--users", os.path.join(data, "user_mapping.parquet"), "--out", out,
          "--checkpoint", os.path.join(tmp, "ck"), "--path", inbox, "--available-now"], spark)
    lists_dir = os.path.join(out, "lists")
    assert store.read_store(spark, lists_dir).count() > 0

    compact = os.path.join(tmp, "compact")
    main(["compact", "--store", lists_dir, "--out", compact], spark)
    n_users = spark.read.parquet(compact).count()
    assert n_users == store.read_store(spark, lists_dir).select("user_idx").distinct().count()

    report = os.path.join(tmp, "report")
    main(["report", "--store", lists_dir, "--metrics", os.path.join(model_dir, "metrics"),
          "--out", report], spark)
    rep = spark.read.json(report).first()
    assert rep.statut == "SUCCES" and rep.fichiers_generes >= 1

    main(["check", f"ratings={os.path.join(data, 'cleaned_reviews.parquet')}:parquet",
          f"model={os.path.join(model_dir, 'als_model')}:model"], spark)


def test_metrics_text_form(spark, tmp):
    from ratewise import schemas
    from ratewise.operators.report import metrics_text
    m = spark.createDataFrame([((20, 0.2, 15), 0.8186, 0.8432)], schemas.METRICS)
    text = metrics_text(m).first().rmse_info
    assert text.splitlines() == ["Meilleure config : {'rank': 20, 'regParam': 0.2, 'maxIter': 15}",
                                 "RMSE validation  : 0.8186", "RMSE test final  : 0.8432"]
