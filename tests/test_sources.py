"""Dirty inputs: CSV quoting, bad casts, store encodings, missing records."""

import os

from ratewise import config, schemas
from ratewise.operators import serve
from ratewise.sources import records, store
from ratewise.sources.reviews import read_review_csv


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


CSV = (
    'Id,ProductId,UserId,ProfileName,Score,Time,Text\n'
    '1,P1,U1,"Ann ""the critic""",5,1303862400,"fine"\n'
    '2,P2,U2,Bob,4,1303862401,"line one\nline two, with comma"\n'
    '3,P3,U3,Cy,abc,1303862402,bad score\n'
    '4,P4,U4,Di,3,,missing time\n'
)


def test_csv_quotes_and_embedded_newlines(spark, tmp):
    p = os.path.join(tmp, "reviews.csv")
    _write(p, CSV)
    df = read_review_csv(spark, p)
    assert df.schema == schemas.REVIEW
    rows = {r.UserId: r for r in df.collect()}
    assert set(rows) == {"U1", "U2", "U3", "U4"}  # no bogus rows from the newline
    assert rows["U1"].Score == 5.0 and rows["U1"].Time == 1303862400
    assert rows["U2"].ProductId == "P2" and rows["U2"].Score == 4.0
    assert rows["U3"].Score is None          # non-numeric -> null, no failure
    assert rows["U4"].Time is None           # missing -> null
    assert df.dropna().count() == 2


def _store_fixture(root):
    # batch folders as the sink writes them, plus a loose file of the
    # reference's layout, nested folders, blank and broken lines
    _write(os.path.join(root, "batch_id=0", "part-0.json"),
           '{"user_idx": 1, "recommendations": [{"product_idx": 10, "rating": 4.5}]}\n'
           '\n'
           '{"user_idx": 2, "recommendations": [{"0": 20, "1": 3.25}, [21, 2.5], "odd", {"x": 1}]}\n')
    _write(os.path.join(root, "batch_id=1", "part-0.json"),
           '{"user_idx": 1, "recommendations": [[11, 4.75], [12, 4.0]]}\n'
           'this is not json\n'
           '{"recommendations": []}\n')
    _write(os.path.join(root, "nested", "deeper", "x.json"),
           '   \n{"user_idx": 3, "recommendations": [{"product_idx": 30, "rating": 1.0}]}\n')
    _write(os.path.join(root, "empty.json"), "")
    _write(os.path.join(root, "notes.txt"), '{"user_idx": 99}\n')


def test_store_encodings_and_tolerance(spark, tmp):
    _store_fixture(tmp)
    st = store.read_store(spark, tmp)
    rows = st.collect()
    assert sorted(r.user_idx for r in rows) == [1, 1, 2, 3]
    by = {(r.user_idx, r.batch_id): r.recommendations for r in rows}
    recs2 = by[(2, 0)]
    # named dict, positional dict, two-element list kept; a string dropped;
    # a dict without index keys kept with a null index and score 0
    assert [(e.product_idx, e.rating) for e in recs2] == [(20, 3.25), (21, 2.5), (None, 0.0)]
    assert [(e.product_idx, e.rating) for e in by[(1, 1)]] == [(11, 4.75), (12, 4.0)]
    latest = {r.user_idx: r for r in serve.latest_lists(st, store.STORE_ORDER).collect()}
    assert [e.product_idx for e in latest[1].recommendations] == [11, 12]  # highest batch wins
    assert store.count_files(spark, tmp) == 3  # each non-empty *.json once


def test_labels_for_missing_index(spark, tmp):
    _store_fixture(tmp)
    lists = serve.latest_lists(store.read_store(spark, tmp), store.STORE_ORDER)
    req = spark.createDataFrame([(2, 20)], "user_id int, n int")
    row = serve.lookup(req, lists).first()
    assert row.recommendations == ["Product_20", "Product_21", "Product_?"]
    assert [d.score for d in row.details] == [3.25, 2.5, 0.0]


def test_missing_records_give_defaults(spark, tmp):
    m = records.read_metrics(spark, os.path.join(tmp, "nope"))
    assert m.count() == 0 and m.schema == schemas.METRICS
    r = records.read_report(spark, os.path.join(tmp, "nope"))
    assert r.count() == 0
    from ratewise.operators import report
    st = report.stats(spark, os.path.join(tmp, "nostore"), os.path.join(tmp, "nope"),
                      os.path.join(tmp, "nope"))
    row = st.first()
    assert row.total_utilisateurs_avec_recommandations == 0
    assert row.rmse_info == config.METRICS_MISSING_TEXT
    assert row.rapport_pipeline is None and row.statut_pipeline is None


def test_report_status_warns_without_files(spark, tmp):
    from ratewise.operators import report
    metrics = spark.createDataFrame([((20, 0.2, 15), 0.81, 0.83)], schemas.METRICS)
    os.makedirs(os.path.join(tmp, "empty_store"))
    rep = report.run_report(spark, metrics, os.path.join(tmp, "empty_store")).first()
    assert rep.statut == config.STATUS_WARN and rep.fichiers_generes == 0
    assert rep.modele.config.rank == 20 and rep.modele.rmse_test == 0.83
    import datetime
    datetime.datetime.fromisoformat(rep.date_execution)


def test_readiness_raises_on_missing(spark, tmp):
    import pytest
    from ratewise.operators import report
    with pytest.raises(FileNotFoundError):
        report.readiness(spark, {"model": (os.path.join(tmp, "no_model"), "model")})
    df = report.readiness(spark, {"model": (os.path.join(tmp, "no_model"), "model")}, strict=False)
    assert df.first().present is False


def test_publish_skips_incomplete_reviews(spark, tmp):
    from ratewise.sinks.writers import publish_messages
    from ratewise.streaming.parse import parse_messages
    df = spark.createDataFrame(
        [("U1", "P1", 5.0, 10), ("U2", "P2", 4.0, None), ("U3", None, 3.0, 12),
         ("U4", "P4", float("nan"), 13)], "UserId string, ProductId string, Score float, Time long")
    publish_messages(df, fmt="text", path=tmp + "/inbox")
    back = parse_messages(spark.read.text(tmp + "/inbox")).collect()
    assert [(r.UserId, r.ProductId, r.Score, r.Time) for r in back] == [("U1", "P1", 5.0, 10)]


def test_records_in_the_forms_met_in_practice(spark, tmp):
    """Three-line text, indented JSON and JSON lines read to the same record."""
    import json
    record = {"config": {"rank": 15, "regParam": 0.1, "maxIter": 12}, "rmse_validation": 0.9, "rmse_test": 1.25}
    texts = {"a.txt": "Meilleure config : {'rank': 15, 'regParam': 0.1, 'maxIter': 12}\nRMSE validation  : 0.9\nRMSE test final  : 1.25\n",
             "b.json": json.dumps(record, indent=2), "c.json": json.dumps(record) + "\n"}
    for name, text in texts.items():
        _write(os.path.join(tmp, name), text)
        rows = records.read_metrics(spark, os.path.join(tmp, name)).collect()
        assert [r.asDict(recursive=True) for r in rows] == [record]
    _write(os.path.join(tmp, "report.json"), json.dumps({"statut": "SUCCES"}, indent=4))
    report = records.read_report(spark, os.path.join(tmp, "report.json")).collect()
    assert len(report) == 1


def test_bare_numbers_and_odd_types_in_the_store(spark, tmp):
    """Bare NaN and Infinity, numbers as text, lists that are none."""
    _write(os.path.join(tmp, "a.json"),
           '{"user_idx": 1, "recommendations": [[1, NaN], {"product_idx": 2, "rating": -Infinity}, [3, 1.0]]}\n'
           '{"user_idx": "2", "recommendations": [{"product_idx": "5", "rating": "2.5"}]}\n'
           '{"user_idx": 3, "recommendations": {"product_idx": 1}}\n'
           '{"user_idx": 4}\n'
           '{"user_idx": 99999999999, "recommendations": []}\n'
           '{"user_idx": 5, "recommendations": [[4, 1.0]]} trailing\n'
           'NaN\n[1, 2]\n')
    got = {r.user_idx: [(e.product_idx, str(e.rating)) for e in r.recommendations] for r in store.read_store(spark, tmp).collect()}
    assert got == {1: [(1, "nan"), (2, "-inf"), (3, "1.0")], 2: [(5, "2.5")], 3: [], 4: [], 5: [(4, "1.0")]}  # what follows an object is ignored


def test_readiness_counts_read_no_column(spark, tmp):
    from conftest import SF001
    from ratewise.operators import report
    inputs = {"orders": (f"{SF001}/orders.parquet", "parquet"), "none": (tmp + "/none", "parquet")}
    rows = {r.name: r.n_rows for r in report.readiness(spark, inputs, strict=False).collect()}
    assert rows == {"orders": spark.read.parquet(inputs["orders"][0]).count(), "none": None}
    plan = spark.read.parquet(inputs["orders"][0]).groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_report_sample_and_product_ids(spark, tmp):
    from ratewise.operators import report
    _store_fixture(tmp)
    rep = report.run_report(spark, spark.createDataFrame([], schemas.METRICS), tmp).first()
    assert [(x.user_idx, x.n_items) for x in rep.echantillon] == [(1, 2), (2, 3), (3, 1)] and rep.modele is None
    lists = serve.latest_lists(store.read_store(spark, tmp), store.STORE_ORDER)
    items = serve.lookup_items(spark.createDataFrame([(2, 20), (3, 1)], "user_id int, n int"), lists)
    names = spark.createDataFrame([("P-twenty", 20), ("P-30", 30)], "ProductId string, product_idx int")
    got = sorted((r.user_id, r.pos, r.ProductId) for r in serve.with_product_ids(items, names).collect())
    assert got == [(2, 1, "P-twenty"), (2, 2, "Product_21"), (2, 3, "Product_?"), (3, 1, "P-30")]
