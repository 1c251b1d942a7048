"""Run records: readiness (V-8), run report (V-9), health (V-1), stats (V-5).

Each is a one-row (or one-row-per-input) DataFrame built from bounded
scalars: file counts, one metrics row, distinct user counts.  Nothing here
reads data rows to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise import config, schemas
from ratewise.functions import scalars as S
from ratewise.operators import compact, serve
from ratewise.sources import records, store

# --- fixed values: text form of the metrics record ------------------------
METRICS_TEXT = ("Meilleure config : {'rank': %d, 'regParam': %s, 'maxIter': %d}\n"
                "RMSE validation  : %.4f\n"
                "RMSE test final  : %.4f\n")
# --- end of fixed values ---------------------------------------------------


def readiness(spark: SparkSession, inputs: dict[str, tuple[str, str]],
              required: tuple[str, ...] | None = None, strict: bool = True) -> DataFrame:
    """V-8: ``(name, path, present, n_rows)`` per input; ``inputs`` maps a
    name to ``(path, kind)`` with kind ``parquet`` (rows counted from the
    footers), ``csv``, ``model`` or ``json``.  Raises when a required input
    is missing (all are required by default)."""
    rows, counts = [], []
    for name, (path, kind) in inputs.items():
        present = store.path_exists(spark, path)
        rows.append((name, path, present))
        if present and kind == "parquet":
            # no column is read: the scan takes the row counts of the footers
            counts.append(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("name", F.lit(name)))
    n_rows = {r["name"]: r["n_rows"] for r in reduce(DataFrame.unionByName, counts).collect()} if counts else {}  # one job
    df = spark.createDataFrame([(*r, n_rows.get(r[0])) for r in rows], "name string, path string, present boolean, n_rows long")
    missing = [r[0] for r in rows if not r[2] and (required is None or r[0] in required)]
    if strict and missing:
        raise FileNotFoundError(f"missing inputs: {', '.join(missing)}")
    return df


def metrics_text(metrics: DataFrame) -> DataFrame:
    """One row ``rmse_info``: the metrics record as text, or the default
    text when there is none."""
    text = metrics.select(F.format_string(
        METRICS_TEXT, F.col("config.rank"), F.col("config.regParam").cast("string"),
        F.col("config.maxIter"), F.col("rmse_validation"), F.col("rmse_test")).alias("rmse_info"))
    return text.limit(1)


def run_report(spark: SparkSession, metrics: DataFrame, store_dir: str,
               broker: str = "", compacted: str | None = None) -> DataFrame:
    """V-9: the report row; the model part is read from the metrics record
    (not hard-coded), status is derived from the files found (F-10), and the
    sample (R-10) shows the first users with the sizes of their lists."""
    n_files, sample = 0, []
    if store.path_exists(spark, store_dir):
        n_files = store.count_files(spark, store_dir)
        sample = [tuple(r) for r in serve.sample_sizes(_latest(spark, store_dir, compacted)).collect()]
    m = metrics.limit(1).collect()
    model = None
    if m:
        r = m[0]
        model = (config.REPORT_ALGORITHM, r["rmse_validation"], r["rmse_test"],
                 tuple(r["config"]) if r["config"] is not None else None,
                 config.REPORT_TRAIN_LABEL, config.REPORT_TEST_LABEL)
    base = spark.createDataFrame(
        [(None, config.REPORT_PIPELINE_LABEL, broker, model, n_files, None, sample)], schemas.REPORT)
    return base.select(
        S.iso_now().alias("date_execution"), "pipeline", "kafka_broker_docker", "modele",
        "fichiers_generes", S.run_status(F.col("fichiers_generes")).alias("statut"), "echantillon")


def _latest(spark: SparkSession, store_dir: str, compacted: str | None) -> DataFrame:
    if compacted is not None:
        return compact.current_lists(spark, store_dir, compacted)
    return serve.latest_lists(store.read_store(spark, store_dir), store.STORE_ORDER)


def _users(spark: SparkSession, store_dir: str, compacted: str | None) -> int:
    """Users with a list: rows of the compacted table (from its footers, if
    all files are folded), else the reduced store."""
    if compacted is None and not store.path_exists(spark, store_dir):
        return 0
    return _latest(spark, store_dir, compacted).count()


def health(spark: SparkSession, store_dir: str, compacted: str | None = None) -> DataFrame:
    """V-1: ``(status, message, utilisateurs_en_cache, dossier_recommandations,
    fichiers_trouves)``; ``compacted`` names the folder of ``compact``."""
    users = _users(spark, store_dir, compacted)
    if store.path_exists(spark, store_dir):
        files = store.count_files(spark, store_dir)
    else:
        files = 0
    return spark.createDataFrame(
        [(config.HEALTH_STATUS, config.HEALTH_MESSAGE, users, store_dir, files)],
        "status string, message string, utilisateurs_en_cache long, "
        "dossier_recommandations string, fichiers_trouves long")


def stats(spark: SparkSession, store_dir: str, metrics_path: str, report_path: str,
          compacted: str | None = None) -> DataFrame:
    """V-5: user count, metrics text, report, model part and status
    (``INCONNU`` when the report has none)."""
    users = _users(spark, store_dir, compacted)
    text_rows = metrics_text(records.read_metrics(spark, metrics_path)).collect()
    text = text_rows[0]["rmse_info"] if text_rows else config.METRICS_MISSING_TEXT
    rep = records.read_report(spark, report_path).limit(1).collect()
    report = rep[0] if rep else None
    row = (users, text, report,
           report["modele"] if report else None,
           (report["statut"] or config.STATUS_UNKNOWN) if report else None)
    schema = ("total_utilisateurs_avec_recommandations long, rmse_info string, "
              f"rapport_pipeline {schemas.REPORT.simpleString()}, "
              f"modele {schemas.REPORT_MODEL.simpleString()}, statut_pipeline string")
    return spark.createDataFrame([row], schema)
