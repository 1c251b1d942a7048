"""Quality by importance resampling.

Two hashed n-gram models (words and word pairs in ``BUCKETS`` buckets, and in
as many buckets the shapes of both) are counted: one of target text (documents
labelled good), one of the raw text (every document).  A word's shape has one
letter for each run of letters and one digit for each run of digits.  A
document's log importance weight is the sum of log(target / raw) over its
n-grams; beyond ``LONG`` n-grams their mean counts ``LONG`` times, so small
steady differences don't add up without bound.
Gumbel noise added to the log weights and a global top-k sample documents
without replacement in proportion to their weights; documents outside the
sample are rejected.

How the labels are spread over languages isn't evidence.  The raw counts of
each language (column ``lang``) are scaled to its n-grams in the target
text before the two are compared, so a language with few labels isn't held
against its documents.  Words of a language say little with fewer than
``LEAST_DOCS`` target documents: all such languages are counted together, by
shapes alone, and shapes alone, which languages share, judge their documents.
A language without any target document isn't judged: it adds nothing to the
models and its documents have weight 1.  A source's share of the good labels
does count.

Without a given ``k``, as many documents are sampled as have a log weight of
``-MARGIN`` or more: those that the target model doesn't clearly speak against.
Ratios are shrunk towards 1 by ``PRIORS`` pseudo-counts, so a rare n-gram is no
evidence; shapes are few and frequent, so they get more.

The target model is fitted on at most ``TARGET_DOCS`` labelled documents
(the first by hash of their id); everything else covers all rows of the
languages judged.  Model ratios are fixed-point integers, so a document's weight
doesn't depend on how rows are batched, and scoring again gives the same decision.

Defined results: null, empty and blank texts have weight 1 (log 0); repeated
rows share weight and noise; equal sampling keys are all in or all out; null
labels are ignored; without a labelled good document every ratio is 1; rows
without a language, or a table without that column, are one language; extra
columns are ignored (or passed through by ``accepted_documents``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import cut, fresh, global_rank, slices

BUCKETS = 1 << 16
TARGET_DOCS = 20_000
PRIORS = (100.0, 1000.0)  # of words, of shapes
MARGIN = 4.0
LONG = 500  # n-grams that count in full
LEAST_DOCS = 10  # target documents of a language judged by its words too
AT_ONCE = 32  # languages counted in one pass; bounds the tables of a task and of the driver
SEED = 17
UNIT = 1 << 16  # fixed-point units of one nat
SLICE_BYTES = 1 << 20

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[[*range(65, 91), *range(97, 123), *range(128, 256)]] = ord("a")  # bytes beyond ASCII count as letters
_SHAPES[48:58] = ord("0")
_BASE, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and start offset of every white-space separated word."""
    codes = np.frombuffer(data, dtype=np.uint8)
    inside = ~_WHITE[codes]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, dtype=np.uint64), at
    opens = np.ones(len(at), dtype=bool)
    opens[1:] = np.diff(at) > 1
    first = np.flatnonzero(opens)
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    powers = np.cumprod(np.full(int(place.max()) + 1, _BASE, dtype=np.uint64))
    h = np.add.reduceat((codes[at].astype(np.uint64) + np.uint64(1)) * powers[place], first)
    h ^= h >> np.uint64(29)
    return h * _MIX, at[first]


def word_hashes(texts: list[bytes], segment: int = SLICE_BYTES) -> list[np.ndarray]:
    """Hashes of the lower-cased words of each text, in order.  A text beyond
    ``segment`` bytes is hashed in parts, cut at white space."""
    out = []
    for text in texts:
        parts, start = [], 0
        while len(text) - start > segment:
            cut_at = max(text.rfind(c, start, start + segment) for c in (b" ", b"\n"))
            if cut_at <= start:  # no white space for a whole segment: up to the next one
                later = [p for p in (text.find(c, start + segment) for c in (b" ", b"\n")) if p >= 0]
                cut_at = min(later, default=len(text))
            parts.append(_hashes(text[start:cut_at].lower())[0])
            start = cut_at
        parts.append(_hashes(text[start:].lower())[0])
        out.append(np.concatenate(parts) if len(parts) > 1 else parts[0])
    return out


def features(texts: list[bytes | None], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, and each text's number of them."""
    texts = [t or b"" for t in texts]
    if all(len(t) <= SLICE_BYTES for t in texts):
        h, at = _hashes(b"\n".join(texts).lower())
        ends = np.cumsum([len(t) + 1 for t in texts])
        words = np.diff(np.searchsorted(at, ends), prepend=0)
    else:
        each = word_hashes(texts)
        h, words = np.concatenate(each), np.array([len(x) for x in each], dtype=np.int64)
    last = np.cumsum(words)[words > 0] - 1  # no pair begins at a text's last word
    pair = (h[:-1] * np.uint64(3) + np.roll(h, -1)[:-1]) * _MIX
    inner = np.ones(len(h), dtype=bool)
    inner[last] = False
    both = np.empty(2 * len(h), dtype=np.int64)
    both[0::2] = (h % np.uint64(buckets)).astype(np.int64)
    both[1::2][:-1] = (pair >> np.uint64(20)).astype(np.int64) % buckets if len(h) else 0
    used = np.ones(2 * len(h), dtype=bool)
    used[1::2] = inner
    return both[used], np.maximum(2 * words - 1, 0)


def shape(text: bytes | None) -> bytes:
    """``text`` with one letter for each run of letters, one digit for each run
    of digits, so ``Nd*** 12,5`` is ``a*** 0,0``; it has as many words."""
    codes = _SHAPES[np.frombuffer(text or b"", dtype=np.uint8)]
    again = (codes[1:] == codes[:-1]) & ((codes[1:] == ord("a")) | (codes[1:] == ord("0")))
    return codes[np.flatnonzero(np.append(True, ~again)[:len(codes)])].tobytes()


def language_of(docs: DataFrame) -> Column:
    """The language as text; empty where there is none."""
    if "lang" not in (c.lower() for c in docs.columns):
        return F.lit("")
    return F.coalesce(F.col("lang").cast("string"), F.lit(""))


@dataclass
class Model:
    """log(target / raw) in units of 1 / UNIT, of words and of shapes (2 x
    buckets); the languages judged by both, and those judged by shapes."""

    ratios: np.ndarray
    judged: list[str]
    few: list[str]


def _counts(docs: DataFrame, langs: list[str], few: list[str], buckets: int) -> DataFrame:
    """(lang, kind, target, bucket, n): n-gram counts of all documents and of the
    ``good`` ones, kind 0 words and 1 shapes; lang is the position in ``langs``,
    one more for the languages ``few``, of which shapes are counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs) + bool(few), 2, 2, buckets), dtype=np.int64)
        for batch in batches:
            for a, b in slices(batch, "text", SLICE_BYTES):
                rows = batch.slice(a, b - a)
                texts, lang = rows.column("text").to_pylist(), rows.column("lang").to_numpy()
                labelled = np.asarray(rows.column("good").to_numpy(zero_copy_only=False), dtype=bool)
                for kind, source in enumerate((texts, map(shape, texts))):
                    found, n = features(list(source), buckets)
                    good, owner = np.repeat(labelled, n), np.repeat(lang, n)
                    for k in np.unique(lang):
                        if kind == 1 or k < len(langs):
                            own = owner == k
                            total[k, kind, 0] += np.bincount(found[own], minlength=buckets)
                            total[k, kind, 1] += np.bincount(found[own & good], minlength=buckets)
        lang, kind, target, bucket = np.nonzero(total)
        yield pa.record_batch([*(pa.array(x.astype(np.int32)) for x in (lang, kind, target, bucket)),
                               pa.array(total[lang, kind, target, bucket])], names=["lang", "kind", "target", "bucket", "n"])
    at = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1 if langs else F.lit(-1)
    at = F.when(F.col("lang").isin(few), len(langs)).otherwise(at).cast("int")
    source = docs.where(F.col("lang").isin(langs + few)).select(
        F.col("text").cast("binary").alias("text"), F.coalesce("good", F.lit(False)).alias("good"), at.alias("lang"))
    return (source.mapInArrow(run, "lang int, kind int, target int, bucket int, n bigint")
            .groupBy("lang", "kind", "target", "bucket").agg(F.sum("n").alias("n")))


def fit_model(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, target_docs: int = TARGET_DOCS,
              priors: tuple[float, float] = PRIORS, least_docs: int = LEAST_DOCS) -> Model:
    """The ratios and the languages judged (``target_docs`` at most).

    ``labels``: doc_id, quality (1 is target text)."""
    chosen = (labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_docs))  # bounds the broadcast
    flagged = (docs.select("doc_id", "text", language_of(docs).alias("lang"))
               .join(F.broadcast(chosen.withColumn("good", F.lit(True))), "doc_id", "left"))
    held = flagged.where("good").groupBy("lang").agg(F.countDistinct("doc_id").alias("n")).collect()
    judged, few = (sorted(r.lang for r in held if (r.n >= least_docs) == enough) for enough in (True, False))
    target, usual = np.zeros((2, buckets)), np.zeros((2, buckets))
    for start in range(0, max(len(judged), bool(few)), AT_ONCE):
        langs, rest = judged[start:start + AT_ONCE], few if start == 0 else []
        table = _counts(flagged, langs, rest, buckets).toArrow()  # languages x 4 x buckets numbers at most
        counts = np.zeros((len(langs) + bool(rest), 2, 2, buckets))
        counts[tuple(table[c].to_numpy() for c in ("lang", "kind", "target", "bucket"))] = table["n"].to_numpy()
        raw, good = np.moveaxis(counts.sum(axis=3), 2, 0)
        target += counts[:, :, 1].sum(axis=0)
        # the target's counts, if in each language it were like the raw text
        usual += (counts[:, :, 0] * (good / np.maximum(raw, 1))[..., None]).sum(axis=0)
    prior = np.array(priors)[:, None]
    return Model(np.rint(np.log((target + prior) / (usual + prior)) * UNIT).astype(np.int64), judged, few)


def fit(docs: DataFrame, labels: DataFrame, **settings) -> tuple[np.ndarray, list[str]]:
    """The ratios of ``fit_model`` and the languages judged by words and shapes."""
    model = fit_model(docs, labels, **settings)
    return model.ratios, model.judged


def with_weight(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs``, all columns, plus the log importance weight."""
    ratios = docs.sparkSession.sparkContext.broadcast(model.ratios)
    raw, worded = fresh(docs, "_utf8", "_worded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shapes = ratios.value
        for batch in batches:
            for a, b in slices(batch, raw, SLICE_BYTES):
                rows = batch.slice(a, b - a)
                texts = rows.column(raw).to_pylist()
                found, n = features(texts, len(words))
                by_words = np.repeat(rows.column(worded).to_numpy(zero_copy_only=False), n)
                each = shapes[features([shape(t) for t in texts], len(words))[0]]  # n-gram by n-gram beside the words
                total = np.concatenate([[0], np.cumsum(each + np.where(by_words, words[found], 0))])
                ends = np.cumsum(n)
                weight = (total[ends] - total[ends - n]) / UNIT * (LONG / np.maximum(n, LONG))
                yield rows.drop_columns([raw, worded]).append_column(name, pa.array(weight))
    schema = docs.withColumn(name, F.lit(0.0)).schema
    schema[name].nullable = True
    lang = language_of(docs)
    return (docs.withColumns({raw: F.when(lang.isin(model.judged + model.few), F.col("text").cast("binary")),
                              worded: lang.isin(model.judged)}).mapInArrow(run, schema))


def sampling_key(weight: str, seed: int = SEED) -> Column:
    """Log weight plus Gumbel noise drawn from a hash of the document."""
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.col(weight) - F.log(-F.log(u))


def kth_key(keys: DataFrame, k: int) -> float | None:
    """The k-th largest key (a cut table with column key); None if there are fewer than 1."""
    if k < 1:
        return None
    ranked = global_rank(keys.select((-F.col("key")).alias("less")), ["less"], "rank", ties=True)
    row = ranked.where(F.col("rank") == k - 1).first()
    return float("-inf") if row is None else -row["less"]


def quality(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, log_weight, sampling_key, kept: one row per document row."""
    scored = with_weight(docs.select("doc_id", "text", language_of(docs).alias("lang")), fit_model(docs, labels), "log_weight")
    scored = cut(scored.select("doc_id", "log_weight", sampling_key("log_weight", seed).alias("key")), "weights")
    least = kth_key(scored, scored.where(F.col("log_weight") >= -MARGIN).count() if k is None else k)
    kept = F.lit(False) if least is None else F.col("key") >= F.lit(least)
    return scored.select("doc_id", "log_weight", F.col("key").alias("sampling_key"), kept.alias("kept"))


def accepted_documents(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED) -> DataFrame:
    """The sampled rows of ``docs``, all columns.  Rows are scored twice (for
    the threshold and for the result) rather than joined or copied."""
    weight, _ = fresh(docs, "_log_weight", "_key")
    scored = with_weight(docs, fit_model(docs, labels), weight)
    keys = cut(scored.select(F.col(weight).alias("log_weight"), sampling_key(weight, seed).alias("key")), "weights")
    least = kth_key(keys, keys.where(F.col("log_weight") >= -MARGIN).count() if k is None else k)
    if least is None:
        return docs.limit(0)
    return scored.where(sampling_key(weight, seed) >= F.lit(least)).select(*docs.columns)
