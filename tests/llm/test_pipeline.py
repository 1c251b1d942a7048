"""Every stage of the pipeline against a brute-force version on a fixture."""
import random

import pytest

import corpus_pipeline as P
from ratewise.llm import packing, quality
from ratewise.llm.queries import BPE
from tests.llm import test_decontaminate, test_exact_dedup, test_simhash


@pytest.fixture(scope="module")
def folder(spark, odd_docs, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    odd_docs.write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(7, 1, 0), (9, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame(test_decontaminate.ITEMS, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def _ids(df):
    return sorted(str(r.doc_id) for r in df.select("doc_id").collect())


def test_stages(spark, odd_docs, folder):
    got = P.quality_stage(spark, odd_docs, folder)
    assert got.schema.names == odd_docs.schema.names
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert _ids(got) == _ids(quality.quality(odd_docs, labels).where("kept"))

    got = P.exact_dedup_stage(spark, odd_docs, folder)
    assert got.schema.names == odd_docs.schema.names
    # one row of each group stays, repeated rows too
    assert _ids(got) == sorted({str(r[0]) + r[4]: str(r[0]) for r in test_exact_dedup.brute(odd_docs) if r[3]}.values())

    docs = got.cache()
    got = P.simhash_stage(spark, docs, folder)
    want = test_simhash.brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got.schema.names == odd_docs.schema.names
    assert _ids(got) == sorted({str(i) for i, _, c in want if i == c})

    small = odd_docs.where("length(text) < 5000 or text is null")
    got = P.decontamination_stage(spark, small, folder)
    rows = test_decontaminate.brute([(r.doc_id, r.text) for r in small.collect()], test_decontaminate.ITEMS)
    assert _ids(got) == sorted(str(r[0]) for r in rows if not r[5])


def test_near_copies_with_null_and_repeated_ids(spark, tmp):
    """One row of each group, also where rows of several groups share an id."""
    rnd = random.Random(3)
    texts = [" ".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=200)) for _ in range(12)]
    rows = [(None, t) for t in texts[:4]] + [(1, texts[4]), (1, texts[5]), (2, texts[5]), (2, texts[6]), (2, texts[6])]
    rows += [(None, texts[7]), (3, texts[7].upper()), (None, texts[8]), (None, texts[8]), (0, texts[9]), (1, texts[9])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in P.simhash_stage(spark, docs, tmp).collect()]
    want = [(None, t) for t in texts[:4]] + [(1, texts[4]), (1, texts[5]), (2, texts[6]), (3, texts[7].upper()),
                                             (None, texts[8]), (0, texts[9])]
    key = lambda r: (r[1], str(r[0]))
    assert sorted(got, key=key) == sorted(want, key=key)


def test_the_longest_of_a_repeated_id_stays(spark, tmp):
    """Texts of one doc_id that differ in white space only, in every order."""
    for order in (1, -1):
        rows = [(i, "a b" + " " * k + "c") for i in (7, None) for k in range(5)][::order] + [(8, "d e"), (8, "d  e")][::order]
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        got = {(r.doc_id, r.text) for r in P.exact_dedup_stage(spark, docs, tmp).collect()}
        assert got == {(7, "a b    c"), (8, "d  e")}


def test_run(spark, folder):
    out = P.run(spark, folder).cache()
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    docs = out.select("doc_id").distinct().count()
    assert 0 < docs == out.where("piece = 0").count()
    assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
    kept = spark.read.parquet(f"{folder}/documents.parquet").join(out.where("piece = 0").select("doc_id"), "doc_id", "left_semi")
    tokens = packing.token_pieces(kept.dropDuplicates(["doc_id"]), BPE).agg({"length": "sum"}).first()[0]
    assert out.agg({"length": "sum"}).first()[0] == tokens


def test_empty_tables(spark, no_docs, folder, tmp):
    no_docs.write.parquet(f"{tmp}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp}/{t}.parquet")
    assert P.run(spark, tmp).count() == 0
