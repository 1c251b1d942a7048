"""Secret scan: three fixed patterns, and dictionary-primed zstandard novelty.

*Base patterns* (assignments, access keys, long hex) are matched over whole
texts; their spans always stay.

*Novelty.*  A candidate is an unbroken string that begins shortly after a
sensitive word and mixes character classes.  Its cost is marginal: the
compressed size of its surroundings with the candidate at their end, less the
size of the surroundings alone, by a zstandard compressor primed with a
dictionary of identifiers.  Names that the surrounding code or other code
uses cost little, whatever their length; a random string costs nearly its
entropy wherever it stands.  A candidate of ``LEAST_BITS`` or more per
character that no base span touches is reported as ``novel``.

Texts are scanned once: the first step keeps the base spans, the candidates
and the merged surroundings of sensitive words (never more than the text).
The dictionary comes from the surroundings of all documents: words counted
once per distinct surrounding text with all candidates blanked (copies don't
make a secret familiar), the most frequent up to ``DICTIONARY_BYTES``.

Defined results: null and empty texts have no spans; one row per document
row, repeated rows and null doc_ids included; texts are never cut, and
work and memory are linear in a text's length; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import cut, slices

# fixed values: base patterns, in their order; least length of the match or of its last group
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
# sensitive words; each holds one of the stems
SENSITIVE = (r"pass(?:word|wd|phrase|code)|pwd|secret|token|credential|authorization|bearer"
             r"|(?:api|access|private|signing|encryption)[_ -]?key")
STEMS = ("pass", "pwd", "secret", "token", "credential", "authorization", "bearer", "key")

CANDIDATE = r"(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/_.-]{15,}[A-Za-z0-9+/_]={0,2}"
REACH = 48              # a candidate begins at most so far behind a sensitive word
CONTEXT = 256           # surroundings on each side of a candidate
LEAST_BITS = 3.5        # marginal bits per character: random hex has 4, random decimals 3.3
DICTIONARY_BYTES = 16 << 10
DICTIONARY_WORDS = 4096
LEAST_CONTEXTS = 2      # distinct surroundings that must use a dictionary word
LEVEL = 9
SLICE_BYTES = 1 << 20

_assign = re.compile(ASSIGN, re.I | re.A)
# the longest run is what the pattern with "+" finds, so short runs needn't be matched
_access = re.compile(f"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}")
_hex = re.compile(f"[0-9a-f]{{{HEX_LEAST},}}")
_sensitive = re.compile(SENSITIVE, re.I | re.A)
_candidate = re.compile(CANDIDATE, re.A)
_classes = tuple(re.compile(c, re.A) for c in ("[a-z]", "(?!^)[A-Z]", "[0-9]"))

SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
SEGMENT = pa.struct([("start", pa.int64()), ("text", pa.string())])
FOUND = ("doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base string, "
         "candidates array<struct<start: bigint, end: bigint>>, segments array<struct<start: bigint, text: string>>")


def _has_sensitive(text: str) -> bool:
    low = text.lower()
    return any(s in low for s in STEMS)


def base_spans(text: str, sensitive: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted; kinds are places in ``KINDS``."""
    out = []
    if sensitive:
        out += [(m.start(), 0, m.end()) for m in _assign.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _access.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _hex.finditer(text)]
    return sorted(out)


def _mixed(word: str) -> bool:
    """At least two of lower case, upper case (behind the first character), digits."""
    return sum(c.search(word) is not None for c in _classes) >= 2


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Candidates of ``text`` outside the base spans, and the merged ranges
    that hold the surroundings of its sensitive words and candidates."""
    words = [m.span() for m in _sensitive.finditer(text)]
    if not words:
        return [], []
    ends = [b for _, b in words]
    taken = _merged([(a, b) for a, _, b in base])
    starts = [a for a, _ in taken]
    found = []
    for m in _candidate.finditer(text, ends[0]):
        a, b = m.span()
        k = bisect_right(ends, a)  # the last sensitive word before it
        at = bisect_left(starts, b)
        if a - ends[k - 1] <= REACH and not (at and taken[at - 1][1] > a) and _mixed(m.group()):
            found.append((a, b))
    return found, _merged([(max(0, a - CONTEXT), min(len(text), b + CONTEXT)) for a, b in words + found])


def _scan(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(SPAN), pa.list_(SEGMENT)]
        names = ["n_assign", "n_access", "n_hex", "base", "candidates", "segments"]
        for batch in batches:
            for a, b in slices(batch, "text", SLICE_BYTES):
                rows, out = batch.slice(a, b - a), []
                for text in rows.column("text").to_pylist():
                    text = text or ""
                    sensitive = _has_sensitive(text)
                    base = base_spans(text, sensitive)
                    found, near = candidates(text, base) if sensitive else ([], [])
                    count = [sum(k == n for _, k, _ in base) for n in range(3)]
                    out.append((*count, ",".join(f"{KINDS[k]}:{x}:{y}" for x, k, y in base),
                                [{"start": x, "end": y} for x, y in found],
                                [{"start": x, "text": text[x:y]} for x, y in near]))
                yield pa.record_batch([rows.column("doc_id"), *map(pa.array, zip(*out), kinds)], names=["doc_id", *names])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FOUND)


def identifier_dictionary(scanned: DataFrame) -> bytes:
    """The most frequent words of the distinct surroundings without their
    candidates, rarest first (zstandard reaches near content more cheaply)."""
    text = F.regexp_replace(F.col("s.text"), CANDIDATE, " ")
    windows = scanned.select(F.explode("segments").alias("s")).select(text.alias("w")).distinct()
    words = windows.select(F.explode(F.array_distinct(F.regexp_extract_all("w", F.lit("[A-Za-z_]{3,24}"), F.lit(0)))).alias("word"))
    common = (words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_CONTEXTS)
              .orderBy(F.desc("n"), "word").limit(DICTIONARY_WORDS).collect())
    out, size = [], 0
    for row in sorted(common, key=lambda r: (-r.n, r.word)):
        size += len(row.word) + 1
        if size > DICTIONARY_BYTES:
            break
        out.append(row.word)
    return " ".join(reversed(out)).encode()


class Novelty:
    """Marginal cost of strings for a compressor primed with ``dictionary``."""

    def __init__(self, dictionary: bytes):
        import zstandard
        primed = None
        if len(dictionary) >= 8:  # the library's least size
            primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=LEVEL)
        self._compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False).compress

    def bits(self, before: str, word: str, after: str) -> float:
        """Marginal bits per character of ``word``.  Its other places in the
        surroundings are blanked, so a secret isn't its own dictionary."""
        around = f"{after} {before}".replace(word, " ").encode()
        return 8 * (len(self._compress(around + word.encode())) - len(self._compress(around))) / len(word)


def novel_spans(found: list[dict], segments: list[dict], novelty: Novelty) -> list[tuple[int, int]]:
    starts, out = [s["start"] for s in segments], []
    for c in found:
        a, b = c["start"], c["end"]
        segment = segments[bisect_right(starts, a) - 1]
        text, at = segment["text"], segment["start"]
        x, y = a - at, b - at
        if novelty.bits(text[max(0, x - CONTEXT):x], text[x:y], text[y:y + CONTEXT]) >= LEAST_BITS:
            out.append((a, b))
    return out


def _all_spans(base: str, novel: list[tuple[int, int]]) -> str:
    if not novel:
        return base
    parts = [p.split(":") for p in base.split(",")] if base else []
    spans = [(int(a), KINDS.index(k), int(b)) for k, a, b in parts] + [(a, len(KINDS) - 1, b) for a, b in novel]
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans: one
    row per document row; spans are ``kind:start:end`` in code points."""
    scanned = cut(_scan(docs), "scanned")
    dictionary = identifier_dictionary(scanned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        for batch in batches:
            digests, spans, counts = [], [], []
            for base, found, near in zip(*(batch.column(c).to_pylist() for c in ("base", "candidates", "segments"))):
                novel = novel_spans(found, near, novelty) if found else []
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append(_all_spans(base, novel))
                counts.append(len(novel))
            keep = [batch.column(c) for c in ("doc_id", "n_assign", "n_access", "n_hex")]
            yield pa.record_batch([*keep, pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                                  names=["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"])
    return scanned.mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_novel bigint, "
                                   "base_sha256 string, spans string")
