"""Language identification for mixed-language text.

A word's script (by code-point ranges) narrows the languages that it can be
in to those seen in that script; hashed character trigrams, with the word's
edges, score each of them; Viterbi over the words with a penalty for every
switch labels spans.  A document's language is the one with most letters.

The model is counted by Spark over all training rows (a fixed number of
buckets per language, whatever the corpus; a task holds the counts of ``HELD``
languages and passes them on).  It has the ``MAX_LANGUAGES`` values of lang with
most training rows, which bounds the model that every task gets; a table with
more values than that has junk in the column.  The Viterbi recursion runs in
lock-step over all documents of a slice.

Defined results: null texts and texts without letters are ``und`` with score
0; rows without a lang or an id aren't learned from (a null id isn't held
out); with nothing to learn from, every text is ``und``; ties go to the
language that sorts first; repeated rows keep one row each; extra columns are
ignored.  ``score`` is the share of the letters that the winner has.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import crc_mod, slices

BUCKETS = 1 << 16
SMOOTHING = 0.5
SWITCH_PENALTY = 6.0
SCRIPT_SHARE = 0.01  # of a language's letters, for the script to be one of its own
SLICE_BYTES = 1 << 21
UNKNOWN = "und"
MAX_LANGUAGES = 512
HELD = 64  # languages whose counts a task holds before it passes them on

# fixed values: script ranges of the Unicode blocks (first, last, script)
LATIN, GREEK, CYRILLIC, HEBREW, ARABIC, INDIC, THAI, HANGUL, KANA, HAN, OTHER = range(1, 12)
SCRIPT_RANGES = (
    (0x0041, 0x024F, LATIN), (0x0250, 0x02AF, LATIN), (0x0370, 0x03FF, GREEK), (0x0400, 0x052F, CYRILLIC),
    (0x0590, 0x05FF, HEBREW), (0x0600, 0x077F, ARABIC), (0x0900, 0x0DFF, INDIC), (0x0E00, 0x0E7F, THAI),
    (0x1100, 0x11FF, HANGUL), (0x1E00, 0x1EFF, LATIN), (0x1F00, 0x1FFF, GREEK), (0x3040, 0x30FF, KANA),
    (0x3400, 0x4DBF, HAN), (0x4E00, 0x9FFF, HAN), (0xAC00, 0xD7AF, HANGUL), (0xF900, 0xFAFF, HAN),
    (0x20000, 0x3FFFF, HAN),
)
_END = 0x110000


@lru_cache(1)
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: is a letter, is part of a word (letters, marks), script."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(_END)]
    letter = np.array([k == "L" for k in kinds])
    word = np.array([k in "LM" for k in kinds])
    script = np.full(_END, OTHER, dtype=np.uint8)
    for a, b, s in SCRIPT_RANGES:
        script[a:b + 1] = s
    return letter, word, script


def _code_points(text: str) -> np.ndarray:
    """Lower-cased code points, as many as the text has."""
    low = text.replace("İ", "i").lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _trigrams(codes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of word characters and the bucket of each one's trigram."""
    _, word, _ = _characters()
    inside = np.where(word[codes], codes, 0).astype(np.uint32)
    padded = np.concatenate([[0], inside, [0]]).astype(np.uint32)
    at = np.flatnonzero(inside)
    h = padded[at] * np.uint32(0x9E3779B1) + padded[at + 1] * np.uint32(0x85EBCA77) + padded[at + 2] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return at, ((h >> np.uint32(8)) % np.uint32(buckets)).astype(np.int64)


def _segments(text: str, size: int) -> Iterator[str]:
    """The text in parts of about ``size``, cut where no word goes on (or
    anyway where one is longer than a part)."""
    start = 0
    while len(text) - start > size:
        end = max(text.rfind(c, start + size // 2, start + size) for c in " \n") + 1
        end = end if end > start else start + size
        yield text[start:end]
        start = end
    yield text[start:]


@dataclass
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # (buckets, languages) log probabilities
    scripts: np.ndarray  # (scripts, languages) whether the language uses the script
    penalty: float = SWITCH_PENALTY

    def words(self, text: str, segment: int = SLICE_BYTES) -> tuple[np.ndarray, ...]:
        """Per word: start, end, letters, and a score for every language."""
        letter, _, script = _characters()
        done, base = [], 0
        for part in _segments(text, segment):
            codes = _code_points(part)
            at, found = _trigrams(codes, len(self.scores))
            if len(at):
                opens = np.ones(len(at), dtype=bool)
                opens[1:] = np.diff(at) > 1
                first = np.flatnonzero(opens)
                last = np.append(first[1:], len(at)) - 1
                score = np.add.reduceat(self.scores[found], first, axis=0)
                usual = self.scripts[script[codes[at[first]]]]
                usual = usual | ~usual.any(axis=1, keepdims=True)
                score = np.where(usual, score, score.min(axis=1, keepdims=True) - 50)
                n = np.add.reduceat(letter[codes[at]].astype(np.int64), first)
                done.append((at[first] + base, at[last] + base + 1, n, score))
            base += len(part)
        if not done:
            zero = np.zeros(0, dtype=np.int64)
            return zero, zero, zero, np.zeros((0, len(self.languages)))
        return tuple(np.concatenate(x) for x in zip(*done))


def best_paths(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """The best state of every word.  ``scores``: words x states, documents one
    after another with ``counts`` words; a change of state costs ``penalty``.
    All documents take a step at once, the longest ones to the end."""
    order = np.argsort(-counts, kind="stable")
    first = (np.cumsum(counts) - counts)[order]
    steps = int(counts.max(initial=0))
    active = np.searchsorted(-counts[order], -np.arange(steps), side="left")
    value = np.zeros((len(counts), scores.shape[1]))
    back = np.empty(scores.shape, dtype=np.int16)
    states, rows = np.arange(scores.shape[1], dtype=np.int16), np.arange(len(counts))
    for t in range(steps):
        m = active[t]
        w, before = first[:m] + t, value[:m]
        best = before.argmax(axis=1)
        moved = (before[rows[:m], best] - penalty)[:, None]
        stay = before >= moved
        back[w] = np.where(stay, states, best[:, None])
        value[:m] = np.where(stay, before, moved) + scores[w]
    path = np.empty(len(scores), dtype=np.int16)
    now = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        m = active[t]
        w = first[:m] + t
        path[w] = now[:m]
        now[:m] = back[w, now[:m]]
    return path


def _training_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """(lang, bucket, n); buckets beyond ``buckets`` count letters by script."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, _, script = _characters()
        total: dict[str, np.ndarray] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, own in total.items():
                at = np.flatnonzero(own)
                yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])],
                                      names=["lang", "bucket", "n"])
            total.clear()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if lang not in total:
                    if len(total) == HELD:
                        yield from passed_on()
                    total[lang] = np.zeros(buckets + OTHER + 1, dtype=np.int64)
                own = total[lang]
                for part in _segments(text, SLICE_BYTES):
                    codes = _code_points(part)
                    _, found = _trigrams(codes, buckets)
                    own[:buckets] += np.bincount(found, minlength=buckets) if len(found) > buckets // 8 else 0
                    if 0 < len(found) <= buckets // 8:
                        np.add.at(own, found, 1)
                    own[buckets:] += np.bincount(script[codes[letter[codes]]], minlength=OTHER + 1)
        yield from passed_on()
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    return rows.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING,
        max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Learn from every row of ``docs`` (lang, text) that has both, for the
    ``max_languages`` with most rows (ties: the name that sorts first)."""
    used = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    top = [r.lang for r in used.orderBy(F.desc("n"), "lang").limit(max_languages + 1).collect()]
    if len(top) > max_languages:
        docs = docs.where(F.col("lang").isin(top[:max_languages]))
    table = _training_counts(docs, buckets).toPandas()  # languages x buckets numbers
    languages = sorted(table["lang"].unique().tolist())
    counts = np.zeros((buckets + OTHER + 1, len(languages)))
    counts[table["bucket"], np.searchsorted(languages, table["lang"])] = table["n"]
    grams, letters = counts[:buckets], counts[buckets:]
    scores = np.log((grams + smoothing) / (grams.sum(axis=0) + smoothing * buckets))
    scripts = letters > SCRIPT_SHARE * letters.sum(axis=0)
    return LanguageModel(languages, scores.astype(np.float32), scripts)


def _label(model: LanguageModel, texts: list[str | None]):
    """Per text its words (start, end, letters) and their states."""
    found = [model.words(t or "") for t in texts]
    counts = np.array([len(f[0]) for f in found], dtype=np.int64)
    path = best_paths(np.concatenate([f[3] for f in found]), counts, model.penalty)
    ends = np.cumsum(counts)
    return [(*f[:3], path[e - n:e]) for f, n, e in zip(found, counts, ends)]


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score: one row per document row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for a, b in slices(batch, "text", SLICE_BYTES):
                rows = batch.slice(a, b - a)
                langs, shares = [], []
                texts = rows.column("text").to_pylist()
                for _, _, n, path in _label(model, texts) if model.languages else [([], [], np.zeros(0, int), [])] * len(texts):
                    letters = np.bincount(path, weights=n, minlength=1) if len(n) else np.zeros(1)
                    total = letters.sum()
                    langs.append(model.languages[int(letters.argmax())] if total else UNKNOWN)
                    shares.append(float(letters.max() / total) if total else 0.0)
                yield pa.record_batch([rows.column("doc_id"), pa.array(langs, pa.string()), pa.array(shares, pa.float64())],
                                      names=["doc_id", "lang_pred", "score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double")


def language_spans(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, start, end, lang: maximal runs of words in one language (code
    points of the text, end exclusive)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches if model.languages else ():
            for a, b in slices(batch, "text", SLICE_BYTES):
                rows, out = batch.slice(a, b - a), []
                for doc_id, (start, end, _, path) in zip(rows.column("doc_id").to_pylist(),
                                                         _label(model, rows.column("text").to_pylist())):
                    edges = np.flatnonzero(np.diff(path, prepend=-1, append=-1))
                    out += [(doc_id, int(start[x]), int(end[y - 1]), model.languages[path[x]]) for x, y in zip(edges, edges[1:])]
                if out:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                          names=["doc_id", "start", "end", "lang"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, start bigint, end bigint, lang string")


def language_id(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score.  The model learns from the rows
    whose crc32(doc_id) modulo ``folds`` isn't ``held_out``."""
    fold = crc_mod(F.col("doc_id"), folds)
    model = fit(docs.where(fold != held_out))
    return predict(docs, model).select(
        "doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
