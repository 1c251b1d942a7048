"""Language id, quality and the lattice model: brute force and held-out checks."""
import itertools
import math
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import language, lattice_lm, quality
from ratewise.llm.queries import PIECES

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# --- language ----------------------------------------------------------------

def test_paths_equal_brute_force():
    rnd = np.random.default_rng(1)
    counts = np.array([3, 0, 5, 1])
    scores = rnd.normal(size=(9, 3)) * 3
    got, at = language.best_paths(scores, counts, 1.5), 0
    for n in counts:
        own = scores[at:at + n]
        value = lambda p: sum(own[k, s] for k, s in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: E731, B023
        best = max(itertools.product(range(3), repeat=int(n)), key=value)
        assert tuple(got[at:at + n]) == best
        at += n


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = language.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").cache()
    assert got.where("lang_pred = lang").count() / got.count() > 0.98
    assert got.where("score < 0 or score > 1").count() == 0


def test_mixed_text_and_scripts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(
        [("the rain in the plain and the hills are nice", "en"), ("der Regen und die Berge sind schön", "de"),
         ("дождь идет над полем и лесом", "ru")] * 20)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    text = "the rain and the hills, der Regen und die Berge; дождь над лесом 北京"
    docs = spark.createDataFrame([(1, text), (2, "1234 !!"), (3, None), (4, ""), (5, "İ дождь " * 50_000)], "doc_id long, text string")
    spans = [(r.lang, text[r.start:r.end]) for r in language.language_spans(docs, model).where("doc_id = 1").orderBy("start").collect()]
    assert [s[0] for s in spans] == ["en", "de", "ru"] and spans[0][1].startswith("the rain") and spans[1][1].startswith("der")
    pred = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, model).collect()}
    assert pred[2] == pred[3] == pred[4] == ("und", 0.0) and pred[5][0] == "ru"
    whole, parts = model.words(text), model.words(text, segment=20)
    assert [a.tolist() for a in whole[:3]] == [a.tolist() for a in parts[:3]]


def test_letters_beyond_the_second_plane(spark):
    han = "".join(map(chr, (0x30000, 0x30FFF, 0x31350, 0x323AF)))
    rows = [(2 * i, "дождь идет над полем", "ru") for i in range(20)] + [(2 * i + 1, f"北京 {han} 上海", "zh") for i in range(20)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sum(model.words(f"{han} 1 {han}")[2].tolist()) == 8
    docs = spark.createDataFrame([(1, han), (2, "\U0001F600 12 \U000E0001 \U0010FFFD")], "doc_id long, text string")
    pred = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, model).collect()}
    assert pred == {1: ("zh", 1.0), 2: ("und", 0.0)}


def test_language_of_odd_rows(odd_docs, no_docs):
    got = language.language_id(odd_docs)
    assert got.count() == odd_docs.count()
    assert got.where("doc_id in (1, 2, 3, 16) and lang_pred != 'und'").count() == 0
    assert got.where("doc_id is null and held_out").count() == 0
    assert language.language_id(no_docs).count() == 0
    assert language.language_id(odd_docs.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred != 'und'").count() == 0


# --- quality -----------------------------------------------------------------

def test_features_are_words_and_pairs():
    texts = [b"one Two  three", b"", None, b"two three", b"x" * (3 << 20) + b" one two"]
    bucket, n = quality.features(texts)
    assert n.tolist() == [5, 0, 0, 3, 5]
    ends = np.cumsum(n)
    a, b, c = (Counter(bucket[e - k:e].tolist()) for e, k in ((ends[0], 5), (ends[3], 3), (ends[4], 5)))
    assert not b - a  # "two three": both words and their pair
    assert sum((a & c).values()) == 3  # one, two and their pair
    small = quality.features(texts[:4])
    assert bucket[:8].tolist() == small[0].tolist()


def test_bad_text_is_rejected_and_good_text_kept(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality(docs, labels).join(labels, "doc_id").cache()
    assert got.where("quality = 0 and kept").count() <= 0.1 * got.where("quality = 0").count()
    assert got.where("quality = 1 and kept").count() >= 0.8 * got.where("quality = 1").count()


def test_uneven_labels_keep_held_out_good_text_of_every_language(spark):
    """German has a third of its labels, Spanish none, the others half."""
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(12))
    share = F.when(F.col("lang") == "de", 4).when(F.col("lang") == "es", 0).otherwise(6)
    known = labels.join(docs.select("doc_id", "lang"), "doc_id").where(part < share).select(labels.columns).cache()
    got = quality.quality(docs, known).join(docs.select("doc_id", "lang"), "doc_id").cache()
    held = got.join(labels, "doc_id").join(known, "doc_id", "left_anti").where("quality = 1")
    kept = {r.lang: r.share for r in held.groupBy("lang").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert len(kept) == 4 and min(kept.values()) > 0.95
    assert got.where("lang = 'es' and log_weight != 0").count() == 0
    assert got.where("lang != 'es' and log_weight != 0").count() > 500
    bad = got.join(labels.where("quality = 0"), "doc_id").where("lang = 'en'")
    assert bad.where("kept").count() <= 0.1 * bad.count()


def test_shapes():
    assert quality.shape("Nd*** 12,5  größe\nA1b2 北京。".encode()) == b"a*** 0,0  a\na0a0 a"
    assert quality.shape(b"") == quality.shape(None) == b"" and quality.shape(b"!!") == b"!!"


def test_a_language_with_three_labels_rejects_bad_text(spark):
    """Held out: every label of Spanish and German but three good ones each."""
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    lang = labels.join(docs.select("doc_id", "lang"), "doc_id").cache()
    three = [r.doc_id for x in ("es", "de") for r in
             lang.where((F.col("lang") == x) & (F.col("quality") == 1)).orderBy("doc_id").limit(3).collect()]
    rare = F.col("lang").isin("es", "de")
    got = quality.quality(docs, lang.where(~rare | F.col("doc_id").isin(three)).select(labels.columns)).join(lang, "doc_id")
    held = got.where(rare & ~F.col("doc_id").isin(three)).groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share"))
    share = {r.quality: r.share for r in held.collect()}
    assert share[1] > 0.95 and share[0] < 0.4


def test_weights_equal_brute_force(spark):
    """Every document's weight anew: two languages judged by words and shapes,
    two by shapes together, one without labels, one document beyond LONG."""
    rnd = np.random.default_rng(4)
    stock = {x: [f"{x}{i}{'!' * (i % 3)}" for i in range(30)] for x in ("aa", "bb", "cc", "dd", "ee")}
    rows = [(i, None if i % 37 == 0 else " ".join(rnd.choice(stock[x], size=900 if i == 40 else int(rnd.integers(0, 60)))), x)
            for i, x in enumerate(("aa", "bb", "cc", "dd", "ee") * 24)]
    good = {i for i, _, x in rows if (x in ("aa", "bb") and i % 3) or (x == "cc" and i < 25) or (x == "dd" and i < 10)}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in good] + [(1000, 1), (2, 0)], "doc_id long, quality int")

    def grams(text, kind):
        raw = (text or "").encode()
        bucket, _ = quality.features([quality.shape(raw) if kind else raw])
        return Counter(bucket.tolist())
    strata = ([{"aa"}, {"bb"}], [{"aa"}, {"bb"}, {"cc", "dd"}])
    tables = []
    for kind, prior in enumerate(quality.PRIORS):
        target, usual = Counter(), Counter()
        for members in strata[kind]:
            raw, own = Counter(), Counter()
            for i, text, x in rows:
                if x in members:
                    raw += grams(text, kind)
                    own += grams(text, kind) if i in good else Counter()
            target += own
            for bucket, n in raw.items():
                usual[bucket] += n * sum(own.values()) / sum(raw.values())
        tables.append({b: math.log((target[b] + prior) / (usual[b] + prior)) for b in usual})
    got = {r.doc_id: r.log_weight for r in quality.quality(docs, labels).collect()}
    assert len(got) == len(rows)
    for i, text, x in rows:
        n = sum(grams(text, 0).values())
        kinds = [k for k in (0, 1) if any(x in members for members in strata[k])]
        weight = sum(m * tables[k][b] for k in kinds for b, m in grams(text, k).items()) * quality.LONG / max(n, quality.LONG)
        assert got[i] == pytest.approx(weight, abs=(2 * n + 1) / quality.UNIT)
    assert any(got[i] != 0 for i, _, x in rows if x in ("cc", "dd")) and not any(got[i] for i, _, x in rows if x == "ee")


def test_languages_are_counted_in_several_passes(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    whole, judged = quality.fit(docs, labels)
    monkeypatch.setattr(quality, "AT_ONCE", 3)
    parts, again = quality.fit(docs, labels)
    assert judged == again == ["de", "en", "es", "fr"] and np.abs(whole - parts).max() <= 1
    alone, one = quality.fit(docs.drop("lang"), labels)
    assert one == [""] and np.abs(whole - alone).max() > quality.UNIT // 10


def test_top_k_and_stage_agree(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(7, 1, 0), (9, 1, None), (8, None, 0), (None, 1, 0), (200, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    got = quality.quality(odd_docs, labels, k=20).cache()
    assert got.count() == odd_docs.count()
    kept = got.where("kept")
    least = kept.agg(F.min("sampling_key")).first()[0]
    assert got.where(F.col("sampling_key") > least).count() < 20 <= kept.count()
    stage = quality.accepted_documents(odd_docs, labels, k=20)
    assert stage.schema.names == odd_docs.schema.names
    assert sorted(str(r.doc_id) for r in stage.collect()) == sorted(str(r.doc_id) for r in kept.collect())
    assert quality.quality(odd_docs, labels, k=0).where("kept").count() == 0
    assert quality.quality(odd_docs, labels.limit(0)).where("log_weight != 0").count() == 0
    assert quality.quality(no_docs, labels).count() == 0


# --- many languages ----------------------------------------------------------

def test_many_languages_are_counted_in_bounded_memory(spark, monkeypatch):
    """Junk in the column: counts are passed on, the model has a bound, and
    the languages that are really there are still told apart."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("text", "lang").coalesce(2)
    junk = docs.select("text", F.concat(F.lit("junk"), F.monotonically_increasing_id().cast("string")).alias("lang"))
    every = docs.unionByName(junk.where("text IS NOT NULL"))
    whole = language.fit(every)
    monkeypatch.setattr(language, "HELD", 3)
    again = language.fit(every)
    assert whole.languages == again.languages and np.array_equal(whole.scores, again.scores)
    assert len(whole.languages) > 100
    few = language.fit(every, max_languages=4)
    plain = language.fit(docs)
    assert few.languages == plain.languages and np.array_equal(few.scores, plain.scores)


# --- lattice -----------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return lattice_lm.Vocabulary(PIECES)


def _segmentations(word, index, p):
    """Sum over every segmentation, by recursion."""
    if not word:
        return 1.0
    total = p[-3] * 256.0 ** -len(word[0].encode()) * _segmentations(word[1:], index, p)
    for n in range(1, len(word) + 1):
        k = index.get(word[:n])
        if k is not None:
            total += p[k] * _segmentations(word[n:], index, p)
    return total


def test_lattice_sums_all_segmentations(vocabulary):
    index = {w: k for k, w in enumerate(vocabulary.pieces)}
    counts = np.stack([np.append(vocabulary.start, [1e-4, 0.3]), np.append(vocabulary.start[::-1], [1e-3, 0.1])], axis=1) * 1000
    weights = lattice_lm.PieceWeights.of(counts)
    words = ["the", "theounting", "größe", "北x", "a", "🙂🙂", "unbelievable"]
    got = lattice_lm.lattice_scores(words, vocabulary, weights)
    for k in range(2):
        p = np.exp(weights.log[:, k])
        want = [math.log(_segmentations(lattice_lm.SPACE + w, index, p) * p[-2]) for w in words]
        assert np.allclose(got[:, k], want, rtol=1e-9)
    assert np.isfinite(lattice_lm.lattice_scores(["x" * 3000], vocabulary, weights)).all()


@pytest.mark.parametrize("plain,sparse", [(0, 1000), (0, 0), (10, 20)])
def test_ways_to_sum_a_lattice_agree(vocabulary, monkeypatch, plain, sparse):
    """Plain sums, sums of logarithms and the list of arcs: same scores, same uses."""
    rng = np.random.default_rng(5)
    counts = np.stack([np.append(vocabulary.start, [1e-4, 0.3]) * rng.uniform(0.5, 2, len(vocabulary.start) + 2)
                       for _ in range(5)], axis=1) * 1000
    weights = lattice_lm.PieceWeights.of(counts)
    words = ["the", "unbelievable", "größe", "北京x", "a", "", "theandofthe" * 3, "x1y2" * 8, "🙂" * 6, "counting"]
    classes = np.arange(len(words)) % 5
    want = lattice_lm.lattice_scores(words, vocabulary, weights), lattice_lm.expected_uses(words, classes, vocabulary, weights)
    monkeypatch.setattr(lattice_lm, "PLAIN", plain)
    monkeypatch.setattr(lattice_lm, "SPARSE", sparse)
    got = lattice_lm.lattice_scores(words, vocabulary, weights), lattice_lm.expected_uses(words, classes, vocabulary, weights)
    assert np.allclose(got[0], want[0], rtol=1e-10) and np.allclose(got[1], want[1], rtol=1e-8, atol=1e-12)


@pytest.mark.parametrize("n", [41, 300, 2500])
def test_long_words_are_whole(vocabulary, n):
    """No cut: one stop, and the expected pieces cover every character."""
    weights = lattice_lm.PieceWeights.of(np.append(vocabulary.start, [1e-4, 0.3])[:, None] * 1000)
    word = ("thecountingof北größe" * n)[:n]
    uses = lattice_lm.expected_uses([word], np.zeros(1, dtype=int), vocabulary, weights)[:, 0]
    lengths = np.array([len(p) for p in vocabulary.pieces])
    assert uses[-1] == 1 and math.isclose((uses[:-2] * lengths).sum() + uses[-2], n + 1, rel_tol=1e-9)
    # the score is the log of a sum over segmentations: a bound from one of them
    score = lattice_lm.lattice_scores([word], vocabulary, weights)[0, 0]
    free = (n + 1) * weights.log[-3, 0] - math.log(256) * len((lattice_lm.SPACE + word).encode()) + weights.log[-2, 0]
    assert free < score < 0


def test_a_hundred_thousand_unbroken_characters(vocabulary):
    counts = np.stack([np.append(vocabulary.start, [1e-4, 0.3])] * 3, axis=1) * 1000
    weights = lattice_lm.PieceWeights.of(counts)
    word = "abcde" * 20_000
    began = time.process_time()
    scores = lattice_lm.lattice_scores([word], vocabulary, weights)[0]
    uses = lattice_lm.expected_uses([word], np.array([1]), vocabulary, weights)
    assert np.isfinite(scores).all() and scores[0] == scores[2] < 0
    assert uses[:, 0].sum() == 0 and uses[-1, 1] == 1 and np.isfinite(uses).all()
    assert time.process_time() - began < 60
    # twice as long, about twice the cost of a character less the one start
    half = lattice_lm.lattice_scores(["abcde" * 10_000], vocabulary, weights)[0, 0]
    assert abs(scores[0] / half - 2) < 1e-3


def test_expected_uses_add_up(vocabulary):
    weights = lattice_lm.PieceWeights.of(np.append(vocabulary.start, [1e-4, 0.3])[:, None] * 1000)
    words = ["the", "theounting", "größe", "x" * 100, "🙂" * 50]
    uses = lattice_lm.expected_uses(words, np.zeros(5, dtype=int), vocabulary, weights)[:, 0]
    length = np.array([len(w) for w in vocabulary.pieces] + [1, 0])
    assert math.isclose((uses * length).sum(), sum(len(w) + 1 for w in words), rel_tol=1e-6)


def _split(text):
    return [w for w in (text or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})).encode().split()]


@pytest.mark.parametrize("hot_share", [1, 50])
def test_counts_and_base_equal_brute_force(odd_docs, hot_share):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    fold = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 7
    train = Counter()
    for i, t in rows:
        if i is not None and fold(i) != 2:
            train.update([*_split(t), b""])
    n, v = sum(train.values()), len(train)
    want = sorted((str(i), fold(i) == 2, len(w), sum(train[x] > 0 for x in w), n,
                   sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w)) for i, t in rows for w in [[*_split(t), b""]])
    got = lattice_lm.lattice_lm(odd_docs, PIECES, hot_share=hot_share, em_steps=1)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got.collect())
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert all(r[6] < 0 and math.isfinite(r[6]) for r in got)


def test_document_score_is_the_sum_over_classes(spark, vocabulary):
    """One class, known counts: the interpolated probability by hand."""
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(["the cat", "the dog", "the cat sat", "a newword"])],
                                 "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in lattice_lm.lattice_lm(docs, PIECES, folds=7, held_out=zlib.crc32(b"3") % 7, em_steps=0).collect()}
    train = Counter()
    for r in docs.collect():
        if not out[r.doc_id].held_out:
            train.update([*_split(r.text), b""])
    n, v = sum(train.values()), len(train)
    weights = lattice_lm.PieceWeights.of((np.append(vocabulary.start, [1e-4, 0.3]) * 1000)[:, None])
    for r in docs.collect():
        total = math.log10(train[b""] / (n + v))
        for w in _split(r.text):
            total += math.log10((train[w] + v * math.exp(lattice_lm.lattice_scores([w.decode()], vocabulary, weights)[0, 0])) / (n + v))
        assert math.isclose(out[r.doc_id].score, total, rel_tol=1e-5)


def test_nothing_to_learn_from(spark, no_docs):
    assert lattice_lm.lattice_lm(no_docs, PIECES, em_steps=1).count() == 0
    docs = spark.createDataFrame([(None, "some text", None)], "doc_id long, text string, lang string")
    r = lattice_lm.lattice_lm(docs, PIECES, em_steps=1).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (False, 3, 0, 0, 0.0) and r.score < 0
