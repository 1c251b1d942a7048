"""Benchmark decontamination: one Aho-Corasick automaton over normalised
benchmark text, each document scanned once.

Texts become words (A-Z lower-cased; ASCII digits and letters and everything
beyond ASCII are word characters).  Every distinct benchmark word gets one
character, so a window of words is a short string, the automaton holds one
node per window word, and a match position is a word number: no separator
can hide or make a match.  Word numbers map back to code-point offsets of
the original text.

The automaton is broadcast, so its size is bounded: benchmark items are taken
in blocks of at most ``BLOCK_WORDS`` words, ``BLOCK_BYTES`` of text and ``LETTERS``
distinct words (200 000 random words: 181 MB in the driver while it is built,
68 MB sent).  A longer item is cut into parts that share ``window - 1`` words, so each of its
windows is in one part.  One block is one scan.  A larger benchmark takes one
scan of the documents per block, cut in between; matches are merged per document
row, so nothing is left out.

Defined results: null, empty and wordless texts have no words and no hits;
a wordless item has no window; items with equal text are all counted; an
item_id that repeats is one item; windows of items with a null item_id hit like
any other, but the item isn't counted or listed, having no name; repeated
document rows each keep their row; extra columns of either table are ignored
(or passed through by ``clean_documents``).
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import cut, fresh, slices

WINDOW_WORDS = 10
BLOCK_WORDS = 200_000
BLOCK_BYTES = 16 << 20
LETTERS = 0x10FFFF - 0x800 - 1  # characters but NUL and the surrogates, less one
SLICE_BYTES = 1 << 20

# fixed values: the separators are [\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 48 or 58 <= c < 97 or 123 <= c < 128 else c
                  for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_OTHER = "\x00"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_WORDS).split()


class Scanner:
    """The automaton over the windows of a block of items."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int):
        import ahocorasick
        self._letter: dict[bytes, str] = {}
        windows: dict[str, set[int]] = defaultdict(set)
        for item, text in items:
            coded = "".join(map(self._code, words_of(text)))
            for start in range(max(1, len(coded) - window + 1) if coded else 0):
                named = windows[coded[start:start + window]]
                if item is not None:
                    named.add(item)
        self._automaton = ahocorasick.Automaton()
        for coded, ids in windows.items():
            self._automaton.add_word(coded, (len(coded), tuple(sorted(ids))))
        self._empty = not windows
        if not self._empty:
            self._automaton.make_automaton()

    def _code(self, word: bytes) -> str:
        known = self._letter.get(word)
        if known is None:
            n = len(self._letter) + 1  # 0 stands for words of no item
            known = self._letter[word] = chr(n if n < 0xD800 else n + 0x800)
        return known

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged word spans [first, end) of the windows found, and their items."""
        if self._empty or not words:
            return [], set()
        coded = "".join(map(self._letter.get, words, repeat(_OTHER)))
        spans, items = [], set()
        for last, (n, ids) in self._automaton.iter(coded):
            spans.append((last - n + 1, last + 1))
            items.update(ids)
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _parts(text: bytes | None, size: int, window: int) -> Iterator[list[bytes]]:
    """The words in parts of at most ``size``; every window is in one of them."""
    words = (m.group() for m in _WORD.finditer((text or b"").translate(_TO_WORDS)))
    part = list(islice(words, size))
    while part:
        yield part
        more = list(islice(words, size - window + 1))
        part = part[len(part) - window + 1:] + more if more else []


def item_blocks(items: DataFrame, block_words: int = BLOCK_WORDS,
                window: int = WINDOW_WORDS) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark in blocks of at most ``block_words`` words (two windows, if
    that is more), ``BLOCK_BYTES`` (one part, if that is more) and ``LETTERS``
    distinct words, read block by block."""
    block, words, size_bytes, distinct = [], 0, 0, set()
    size = max(2 * window, min(block_words, LETTERS))
    for r in items.select("item_id", F.col("text").cast("binary").alias("text")).toLocalIterator():
        for part in _parts(r.text, size, window):
            own, text = set(part), b" ".join(part)
            if block and (words + len(part) > block_words or size_bytes + len(text) > BLOCK_BYTES
                          or len(distinct) + len(own - distinct) > LETTERS):
                yield block
                block, words, size_bytes, distinct = [], 0, 0, set()
            block.append((r.item_id, text))
            words, size_bytes = words + len(part), size_bytes + len(text)
            distinct |= own
    if block:
        yield block


def _offsets(text: bytes, spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Code-point offsets [start, end) in the original text of word spans."""
    places = [m.span() for m in _WORD.finditer(text)]
    data = np.frombuffer(text, dtype=np.uint8)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return ([int(before[places[a][0]]) for a, _ in spans], [int(before[places[b - 1][1]]) for _, b in spans])


RESULT = ("doc_id bigint, text binary, n_words bigint, starts array<bigint>, ends array<bigint>, items array<bigint>")


def _add_block(rows: DataFrame, scanner, first: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner.value.scan
        for batch in batches:
            for a, b in slices(batch, "text", SLICE_BYTES):
                part = batch.slice(a, b - a)
                old = [None] * (b - a) if first else list(zip(*(part.column(c).to_pylist() for c in ("starts", "ends", "items"))))
                counts, starts, ends, items = [], [], [], []
                for text, was in zip(part.column("text").to_pylist(), old):
                    words = words_of(text)
                    spans, ids = scan(words)
                    if was:
                        spans, ids = merged([*spans, *zip(was[0], was[1])]), ids.union(was[2])
                    counts.append(len(words))
                    starts.append([s for s, _ in spans])
                    ends.append([e for _, e in spans])
                    items.append(sorted(ids))
                yield pa.record_batch([part.column("doc_id"), part.column("text"), pa.array(counts, pa.int64()),
                                       *(pa.array(x, pa.list_(pa.int64())) for x in (starts, ends, items))],
                                      names=["doc_id", "text", "n_words", "starts", "ends", "items"])
    return rows.mapInArrow(run, RESULT)


def word_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS,
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document row: doc_id, text (UTF-8), n_words, merged hit spans in
    words (starts, ends) and the items found."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    spark, done = docs.sparkSession, 0
    for block in item_blocks(items, block_words, window):
        rows = _add_block(cut(rows, "block") if done else rows,
                          spark.sparkContext.broadcast(Scanner(block, window)), done == 0)
        done += 1
    if not done:
        rows = _add_block(rows, spark.sparkContext.broadcast(Scanner([], window)), True)
    return rows


def hit_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Contaminated passages: doc_id, start, end (code points of the original
    text, end exclusive) and the passage, one row per merged span."""
    @F.pandas_udf("array<struct<start:bigint,end:bigint>>")
    def places(text, starts, ends):
        import pandas as pd
        out = []
        for t, a, b in zip(text, starts, ends):
            s, e = _offsets(t, list(zip(a, b)))
            out.append([{"start": x, "end": y} for x, y in zip(s, e)])
        return pd.Series(out)
    hit = word_spans(docs, items, window).where(F.size("starts") > 0)
    at = hit.select("doc_id", F.col("text").cast("string").alias("text"), F.explode(places("text", "starts", "ends")).alias("p"))
    return at.select("doc_id", "p.start", "p.end", F.expr("substring(text, int(p.start) + 1, int(p.end - p.start))").alias("passage"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = word_spans(docs, items, window, block_words)
    hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
                        (F.size("starts") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS,
                    block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of any item
    occurs, whether the item has an id or not."""
    (raw,) = fresh(docs, "_utf8")
    schema = docs.schema
    for block in item_blocks(items, block_words, window):
        scanner = docs.sparkSession.sparkContext.broadcast(Scanner(block, window))

        def run(batches: Iterator[pa.RecordBatch], scanner=scanner) -> Iterator[pa.RecordBatch]:
            scan = scanner.value.scan
            for batch in batches:
                for a, b in slices(batch, raw, SLICE_BYTES):
                    part = batch.slice(a, b - a)
                    keep = [not scan(words_of(t))[0] for t in part.column(raw).to_pylist()]
                    yield part.drop_columns([raw]).filter(pa.array(keep, pa.bool_()))
        docs = docs.withColumn(raw, F.col("text").cast("binary")).mapInArrow(run, schema)
    return docs
