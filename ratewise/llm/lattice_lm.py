"""Subword-lattice language model: marginal log probability of a document.

A word unseen in training is spelled by the pieces of an existing subword
vocabulary.  All its segmentations count: a forward recursion sums them, each
weighted by the product of its pieces' probabilities.  It runs in log space
wherever a probability could get too small for a float (words beyond ``PLAIN``
characters, and shorter ones that turn out so); for the others the same sums
are taken without logarithms, which is faster and exact to rounding.  Words
are never cut: beyond ``SPARSE`` characters the recursion goes over the arcs
that exist, position by position, so work and memory are linear in the word.  The
vocabulary's own scores are the starting weights; one or more expectation
steps over all distinct training words (the expected uses of each piece in
the lattices) re-weight them for the corpus.  A word seen in training is
also an arc of its own: its count is interpolated with the lattice,

    P_k(w) = (c_k(w) + B_k * lattice_k(w)) / (N_k + B_k),

with B_k the number of distinct tokens (the more distinct ones, the more mass
for new words).  Counts and piece weights are kept per class k of documents
(the languages of the training documents); a document's class is hidden, so
its probability is the sum over the classes of share_k * prod P_k(token).

Counts are shuffled by word.  Words that make up more than one in
``HOT_SHARE`` of all tokens (so at most that many) are broadcast and looked
up where the documents are read; only the rarer words of a document are
shuffled to meet their counts.

Defined results: null and blank texts are the end token alone; rows with a
null doc_id are scored but not learned from, and aren't held out; with no
training rows base_score is 0 and the lattice alone scores; documents with no
lang are a class; classes beyond the ``CLASSES`` most frequent share one;
repeated rows keep one row each; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import crc_mod, cut, slices

HOT_SHARE = 400_000
CLASSES = 15
EM_STEPS = 2
SMOOTHING = 0.01
SLICE_BYTES = 1 << 20
HELD_WORDS = 500_000  # distinct words a task holds before it passes their counts on
END = b""  # the end token; no word is empty
PLAIN = 40  # characters of a word summed without logarithms
SPARSE = 1000  # characters of a word whose arcs are gone through one by one
SMALLEST = 1e-290  # a probability below is left to logarithms
SPARSE_CLASSES = 4  # classes at a time there; bounds the recursion's table
HELD_USES = 1 << 22  # expected uses held before they are added up
SPACE = "▁"  # stands before each word in the vocabulary
LOG10 = math.log(10)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()  # ASCII letters and ASCII white space only, on bytes


# --- the lattice -------------------------------------------------------------

_RADIX = np.uint64(0x9E3779B97F4A7C15)
_MIXES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))
_FLAG_MIX = np.uint64(0x8EBC6AF09C88C6E3)


class Vocabulary:
    """The pieces of a sentencepiece model, found by the hash of a substring."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(sp.get_piece_size())
               if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.pieces = [sp.id_to_piece(i) for i in ids]
        scores = np.array([sp.get_score(i) for i in ids])
        self.longest = max(map(len, self.pieces))
        weight = np.exp(scores)
        if not 0.5 < weight.sum() < 2:  # merge ranks, not log probabilities: a Zipf law over the ranks
            weight = 1 / (np.argsort(np.argsort(-scores)) + 10.0)
        self.start = weight / weight.sum()
        self._fill()

    def _fill(self) -> None:
        """Three-choice hash tables, and a table of flags that most other
        substrings don't pass."""
        hashes = np.array([self._hash(p) for p in self.pieces], dtype=np.uint64)
        self._hashes = np.append(hashes, np.uint64(0))  # index -1: no piece
        self._flags = np.zeros(1 << 21, dtype=bool)
        self._flags[(hashes * _FLAG_MIX >> np.uint64(43)).astype(np.int64)] = True
        self._tables = [np.full(1 << 18, -1, dtype=np.int32) for _ in _MIXES]
        for k, h in enumerate(hashes):
            for table, mix in zip(self._tables, _MIXES):
                slot = (int(h) * int(mix) & (2**64 - 1)) >> 46
                if table[slot] < 0:
                    table[slot] = k
                    break
            else:
                raise ValueError("hash tables too small for this vocabulary")

    @staticmethod
    def _hash(text: str) -> np.uint64:
        h = 0
        for c in text:
            h = (h * int(_RADIX) + ord(c)) & (2**64 - 1)
        return np.uint64(h)

    def arcs(self, codes: np.ndarray) -> list[np.ndarray]:
        """``codes``: length x words code points.  Item l - 1 holds, for starts x
        words, the piece of length l from there, or -1."""
        n, out = len(codes), []
        prefix = np.zeros((n + 1, codes.shape[1]), dtype=np.uint64)
        for j in range(n):
            prefix[j + 1] = prefix[j] * _RADIX + codes[j]
        power = np.ones(1, dtype=np.uint64)
        for length in range(1, min(n, self.longest) + 1):
            power = np.multiply(power, _RADIX)
            h = prefix[length:] - prefix[:-length] * power
            piece = np.full(h.shape, -1, dtype=np.int32)
            open_ = np.flatnonzero(self._flags[(h * _FLAG_MIX >> np.uint64(43)).astype(np.int64)])
            left = h.ravel()[open_]
            for table, mix in zip(self._tables, _MIXES):
                found = table[(left * mix >> np.uint64(46)).astype(np.int64)]
                hit = (found >= 0) & (self._hashes[found] == left)
                piece.ravel()[open_[hit]] = found[hit]
                open_, left = open_[~hit], left[~hit]
            out.append(piece)
        return out


@lru_cache(2)
def shared_vocabulary(path: str) -> Vocabulary:
    """One vocabulary per Python worker, for all its tasks."""
    return Vocabulary(path)


def _by_length(words: list[str], longest: int, cells: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of words of one length: positions, and, as length x words, code
    points and UTF-8 bytes per character."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    for n in np.unique(lengths):
        same = order[np.searchsorted(lengths[order], n):np.searchsorted(lengths[order], n, side="right")]
        step = max(1, cells // (int(n) * min(int(n), longest)))
        for a in range(0, len(same), step):
            at = same[a:a + step]
            text = "".join(words[i] for i in at)
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(at), int(n)).T
            width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
            yield at, np.ascontiguousarray(codes, dtype=np.uint64), np.ascontiguousarray(width)


def _log_sum(terms: np.ndarray) -> np.ndarray:
    """log of the sum of exp over axis 0."""
    top = terms.max(axis=0)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return top + np.log(np.exp(terms - top).sum(axis=0))


@dataclass
class PieceWeights:
    """Log probabilities, per class, of the pieces, then of a character spelled
    by bytes, of the stop after a word, and of no piece (-inf)."""

    log: np.ndarray  # (pieces + 3, classes)

    @staticmethod
    def of(counts: np.ndarray, smoothing: float = SMOOTHING) -> PieceWeights:
        p = counts + smoothing
        with np.errstate(divide="ignore"):
            return PieceWeights(np.log(np.vstack([p / p.sum(axis=0), np.zeros((1, p.shape[1]))])))


def _forward_logs(use: list[np.ndarray], spelled: np.ndarray) -> np.ndarray:
    """Log forward sums of words of one length, positions x words [x classes];
    ``use[k - 1]`` holds the log weight of the arc of length k from each start."""
    n = len(spelled)
    forward = np.full((n + 1, *spelled.shape[1:]), -np.inf)
    forward[0] = 0
    for j in range(1, n + 1):
        terms = [forward[j - k] + use[k - 1][j - k] for k in range(1, min(j, len(use)) + 1)]
        terms.append(forward[j - 1] + spelled[j - 1])
        forward[j] = _log_sum(np.stack(terms))
    return forward


def _arc_list(arcs: list[np.ndarray], word: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and pieces of the arcs of one word of a block, by end."""
    starts = [np.flatnonzero(a[:, word] >= 0) for a in arcs]
    pieces = np.concatenate([a[s, word] for a, s in zip(arcs, starts)])
    ends = np.concatenate([s + k for k, s in enumerate(starts, start=1)])
    order = np.argsort(ends, kind="stable")
    return np.concatenate(starts)[order], ends[order], pieces[order]


def _sparse_logs(starts: np.ndarray, ends: np.ndarray, pieces: np.ndarray, log: np.ndarray, spelled: np.ndarray) -> np.ndarray:
    """As ``_forward_logs`` for one long word: positions x classes, over a
    list of arcs in order of their ends."""
    n = len(spelled)
    forward = np.empty((n + 1, log.shape[1]))
    forward[0] = 0
    bounds = np.searchsorted(ends, np.arange(n + 2)).tolist()
    for j in range(1, n + 1):
        a, b = bounds[j], bounds[j + 1]
        at = forward[j - 1] + spelled[j - 1]
        if b > a:
            at = np.logaddexp(at, np.logaddexp.reduce(forward[starts[a:b]] + log[pieces[a:b]], axis=0))
        forward[j] = at
    return forward


def lattice_scores(words: list[str], vocabulary: Vocabulary, weights: PieceWeights) -> np.ndarray:
    """Natural-log probability of each word, per class: the forward recursion
    over all segmentations of the word with its leading space."""
    out = np.empty((len(words), weights.log.shape[1]))
    log, p = weights.log, np.exp(weights.log)
    for at, codes, width in _by_length([SPACE + w for w in words], vocabulary.longest):
        n, arcs = len(codes), vocabulary.arcs(codes)
        if n <= PLAIN:
            spelled = p[-3] * np.exp(-width * math.log(256))[..., None]
            forward = np.zeros((n + 1, *out[at].shape))
            forward[0] = 1
            for j in range(1, n + 1):
                forward[j] = forward[j - 1] * spelled[j - 1]
                for k in range(1, min(j, len(arcs)) + 1):
                    arc = arcs[k - 1][j - k]
                    some = np.flatnonzero(arc >= 0)
                    forward[j, some] += forward[j - k, some] * p[arc[some]]
            tiny = (forward[n] < SMALLEST).any(axis=1)
            out[at[~tiny]] = np.log(forward[n][~tiny]) + log[-2]
            at, width, arcs = at[tiny], width[:, tiny], [a[:, tiny] for a in arcs]
        if n > SPARSE:
            for w, place in enumerate(at.tolist()):
                found = _arc_list(arcs, w)
                for k in range(0, log.shape[1], SPARSE_CLASSES):
                    own = log[:, k:k + SPARSE_CLASSES]
                    spelled = own[-3] - width[:, w, None] * math.log(256)
                    out[place, k:k + SPARSE_CLASSES] = _sparse_logs(*found, own, spelled)[n] + own[-2]
        elif len(at):
            spelled = log[-3] - width[..., None] * math.log(256)  # characters as free bytes
            out[at] = _forward_logs([log[a] for a in arcs], spelled)[n] + log[-2]
    return out


def expected_uses(words: list[str], classes: np.ndarray, vocabulary: Vocabulary, weights: PieceWeights) -> np.ndarray:
    """Expected number of uses of each event in the lattices of the words,
    each word under the class beside it: (pieces + 2, classes)."""
    log, k_all = weights.log, weights.log.shape[1]
    p, events = np.exp(log), len(vocabulary.pieces) + 2
    total, held = np.zeros(events * k_all), []

    def add(at: np.ndarray, share: np.ndarray, last: bool = False) -> None:
        held.append((at, share))
        if last or sum(len(x) for x, _ in held) > HELD_USES:
            total[:] += np.bincount(np.concatenate([x for x, _ in held]), weights=np.concatenate([x for _, x in held]),
                                    minlength=len(total))
            held.clear()
    for at, codes, width in _by_length([SPACE + w for w in words], vocabulary.longest):
        n, arcs, own = len(codes), vocabulary.arcs(codes), classes[at]
        add((events - 1) * k_all + own, np.ones(len(own)))  # one stop a word
        if n <= PLAIN:
            use = [p[a, own] for a in arcs]  # starts x words
            spelled = p[-3][own] * np.exp(-width * math.log(256))
            forward = np.zeros((n + 1, len(at)))
            forward[0] = 1
            for j in range(1, n + 1):
                forward[j] = forward[j - 1] * spelled[j - 1]
                for k in range(1, min(j, len(arcs)) + 1):
                    forward[j] += forward[j - k] * use[k - 1][j - k]
            backward = np.zeros((n + 1, len(at)))
            backward[n] = 1
            for i in range(n - 1, -1, -1):
                backward[i] = backward[i + 1] * spelled[i]
                for k in range(1, min(n - i, len(arcs)) + 1):
                    backward[i] += backward[i + k] * use[k - 1][i]
            tiny = forward[n] < SMALLEST  # left to logarithms
            backward /= np.where(tiny, np.inf, forward[n])
            for k, (arc, u) in enumerate(zip(arcs, use), start=1):
                start, word = np.nonzero(arc >= 0)
                add(arc[start, word] * k_all + own[word], forward[start, word] * u[start, word] * backward[start + k, word])
            add((events - 2) * k_all + own, (forward[:n] * spelled * backward[1:]).sum(axis=0))
            at, own, width, arcs = at[tiny], own[tiny], width[:, tiny], [a[:, tiny] for a in arcs]
        if n > SPARSE:
            for w, k in enumerate(own.tolist()):
                starts, ends, pieces = _arc_list(arcs, w)
                mine = log[:, k:k + 1]
                spelled = mine[-3] - width[:, w, None] * math.log(256)
                forward = _sparse_logs(starts, ends, pieces, mine, spelled)[:, 0]
                turn = np.argsort(n - starts, kind="stable")  # the same word from its end
                backward = _sparse_logs((n - ends)[turn], (n - starts)[turn], pieces[turn], mine, spelled[::-1])[::-1, 0]
                add(pieces * k_all + k, np.exp(forward[starts] + mine[pieces, 0] + backward[ends] - forward[n]))
                add(np.array([(events - 2) * k_all + k]),
                    np.exp(forward[:n] + spelled[:, 0] + backward[1:] - forward[n]).sum(keepdims=True))
        elif len(at):
            use, spelled = [log[a, own] for a in arcs], log[-3][own] - width * math.log(256)
            forward = _forward_logs(use, spelled)
            # from the end: the arc of length k that starts at i is one that ends at n - i
            backward = _forward_logs([u[::-1] for u in use], spelled[::-1])[::-1]
            for k, (arc, u) in enumerate(zip(arcs, use), start=1):
                start, word = np.nonzero(arc >= 0)
                add(arc[start, word] * k_all + own[word],
                    np.exp(forward[start, word] + u[start, word] + backward[start + k, word] - forward[n, word]))
            add((events - 2) * k_all + own, np.exp(forward[:n] + spelled + backward[1:] - forward[n]).sum(axis=0))
    add(np.zeros(0, dtype=np.int64), np.zeros(0), last=True)
    return total.reshape(events, k_all)


# --- the corpus --------------------------------------------------------------

def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, class, n) with class -1 for rows not learned from.  ``docs``: text
    (UTF-8), class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {}

        def passed_on():
            for k, c in held.items():
                yield pa.record_batch([pa.array(c.keys(), pa.binary()), pa.array([k] * len(c), pa.int32()),
                                       pa.array(c.values(), pa.int64())], names=["word", "class", "n"])
            held.clear()
        for batch in batches:
            for a, b in slices(batch, "text", SLICE_BYTES):
                rows = batch.slice(a, b - a)
                for text, k in zip(rows.column("text").to_pylist(), rows.column("class").to_pylist()):
                    own = held.setdefault(k, Counter())
                    own.update(words_of(text))
                    own[END] += 1
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield from passed_on()
        yield from passed_on()
    return docs.mapInArrow(run, "word binary, class int, n bigint").groupBy("word", "class").agg(F.sum("n").alias("n"))


def _decoded(words: list[bytes]) -> list[str]:
    return [w.decode("utf-8", "replace") for w in words]


def fit_pieces(counts: DataFrame, vocabulary_path: str, classes: int, steps: int = EM_STEPS) -> PieceWeights:
    """Piece weights after ``steps`` expectation steps over the distinct
    training words of each class.  ``counts``: word, class."""
    vocabulary = shared_vocabulary(vocabulary_path)
    start = np.append(vocabulary.start, [1e-4, 0.3]) * 1000
    weights = PieceWeights.of(np.repeat(start[:, None], classes, axis=1))
    words = counts.where((F.col("class") >= 0) & (F.octet_length("word") > 0)).select("word", "class")
    for _ in range(steps):
        shared = counts.sparkSession.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known, total = shared_vocabulary(vocabulary_path), None
            for batch in batches:
                if batch.num_rows:
                    uses = expected_uses(_decoded(batch.column("word").to_pylist()), batch.column("class").to_numpy(),
                                         known, shared.value)
                    total = uses if total is None else total + uses
            if total is not None:
                event, k = np.nonzero(total)
                yield pa.record_batch([pa.array(event.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(total[event, k])],
                                      names=["event", "class", "uses"])
        found = (words.mapInArrow(run, "event int, class int, uses double")
                 .groupBy("event", "class").agg(F.sum("uses").alias("uses")).toPandas())  # vocabulary x classes numbers
        uses = np.zeros((len(vocabulary.pieces) + 2, classes))
        uses[found["event"], found["class"]] = found["uses"]
        weights = PieceWeights.of(uses)
    return weights


def _word_table(counts: DataFrame, vocabulary_path: str, weights: PieceWeights, totals: np.ndarray,
                types: np.ndarray) -> DataFrame:
    """(word, n_all, c, score): uses in all documents, uses in training, and
    log10 P_k(word) per class."""
    k_all = len(totals)
    per_class = [F.coalesce(F.sum(F.when(F.col("class") == k, F.col("n"))), F.lit(0)).alias(f"c{k}") for k in range(k_all)]
    table = counts.groupBy("word").agg(F.sum("n").alias("n_all"), *per_class)
    shared = counts.sparkSession.sparkContext.broadcast(weights)
    extra = np.maximum(types, 1).astype(float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in batches:
            known = known or shared_vocabulary(vocabulary_path)
            for a in range(0, batch.num_rows, 8192):
                rows = batch.slice(a, 8192)
                words = rows.column("word").to_pylist()
                c = np.stack([rows.column(f"c{k}").to_numpy() for k in range(k_all)], axis=1).astype(float)
                lattice = np.exp(lattice_scores(_decoded(words), known, shared.value))
                lattice[[w == END for w in words]] = 0
                with np.errstate(divide="ignore"):
                    score = np.log10((c + extra * lattice) / (totals + extra))
                # a word too long for a probability: the logarithms of the lattice alone
                far = ~np.isfinite(score).all(axis=1)
                if far.any():
                    logs = lattice_scores(_decoded([w for w, f in zip(words, far) if f]), known, shared.value) / LOG10
                    score[far] = np.where(np.isfinite(score[far]), score[far], logs + np.log10(extra / (totals + extra)))
                yield pa.record_batch([rows.column("word"), rows.column("n_all"), pa.array(c.sum(axis=1).astype(np.int64)),
                                       pa.array(list(score.astype(np.float32)), pa.list_(pa.float32()))],
                                      names=["word", "n_all", "c", "score"])
    return table.mapInArrow(run, "word binary, n_all bigint, c bigint, score array<float>")


def _hot_and_rare(docs: DataFrame, hot: pa.Table, k_all: int) -> DataFrame:
    """Per document a row with its hot words summed up (word null), and a row
    per distinct rarer word.  ``docs``: doc_id, held_out, text (UTF-8);
    ``hot``: word, c, score."""
    index = {w: i for i, w in enumerate(hot["word"].to_pylist())}
    c = np.append(hot["c"].to_numpy(), 0)
    score = np.append(np.array(hot["score"].to_pylist()).reshape(-1, k_all), np.zeros((1, k_all)), axis=0)
    shared = docs.sparkSession.sparkContext.broadcast((index, c, score))
    kinds = [("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("word", pa.binary()), ("n", pa.int64()),
             ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.list_(pa.float64()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, c, score = shared.value
        base, none = np.log10(c + 1.0), len(c) - 1
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for a, b in slices(batch, "text", SLICE_BYTES):
                rows, out = batch.slice(a, b - a), []
                for doc_id, held_out, text in zip(*(rows.column(x).to_pylist() for x in ("doc_id", "held_out", "text"))):
                    words = words_of(text)
                    words.append(END)
                    at = np.fromiter(map(index.get, words, repeat(none)), dtype=np.int64, count=len(words))
                    rare = Counter(words[i] for i in np.flatnonzero(at == none).tolist())
                    at = at[at != none]
                    row += 1
                    out.append((row, doc_id, held_out, None, len(words), int((c[at] > 0).sum()), float(base[at].sum()),
                                score[at].sum(axis=0).tolist()))
                    out += [(row, None, None, w, n, None, None, None) for w, n in rare.items()]
                yield pa.record_batch([pa.array(x, t) for x, (_, t) in zip(zip(*out), kinds)], names=[k for k, _ in kinds])
    return docs.mapInArrow(run, "row bigint, doc_id bigint, held_out boolean, word binary, n bigint, n_known bigint, "
                                "base double, score array<double>")


def lattice_lm(docs: DataFrame, vocabulary_path: str, folds: int = 7, held_out: int = 2, hot_share: int = HOT_SHARE,
               em_steps: int = EM_STEPS, max_classes: int = CLASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from rows whose crc32(doc_id) modulo ``folds`` isn't
    ``held_out``."""
    fold = crc_mod(F.col("doc_id"), folds)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                       F.col("lang").cast("string").alias("lang"),
                       F.coalesce(fold == held_out, F.lit(False)).alias("held_out"),
                       F.coalesce(fold != held_out, F.lit(False)).alias("train"))
    # the most frequent languages; one class for the others, if any
    share = rows.where("train").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    top = share.orderBy(F.desc("n"), "lang").limit(max_classes + 1).collect()
    more, top = len(top) > max_classes or not top, top[:max_classes]
    of = F.lit(len(top))
    for k, r in enumerate(top):
        of = F.when(F.col("lang").eqNullSafe(F.lit(r["lang"]).cast("string")), F.lit(k)).otherwise(of)
    k_all = len(top) + more
    counts = cut(_word_counts(rows.select("text", F.when(F.col("train"), of).otherwise(-1).cast("int").alias("class"))), "counts")

    sums = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types"),
                                       F.sum(F.when(F.octet_length("word") == 0, F.col("n"))).alias("docs")).collect()
    totals, types, documents = (np.zeros(k_all, dtype=np.int64) for _ in range(3))
    for r in sums:
        if r["class"] >= 0:
            totals[r["class"]], types[r["class"]], documents[r["class"]] = r["n"], r["types"], r["docs"]
    n_all = sum(r["n"] for r in sums)
    weights = fit_pieces(counts, vocabulary_path, k_all, em_steps)
    words = cut(_word_table(counts, vocabulary_path, weights, totals, types), "words")
    n_train, v_train = int(totals.sum()), words.where("c > 0").count()

    hot = words.where(F.col("n_all") * hot_share > n_all).select("word", "c", "score").toArrow()  # hot_share words at most
    parts = cut(_hot_and_rare(rows.select("doc_id", "held_out", "text"), hot, k_all), "parts")
    per_class = [F.sum(F.col("n") * F.col("score")[k]).alias(f"s{k}") for k in range(k_all)]
    rare = (parts.where(F.col("word").isNotNull()).select("row", "word", "n")
            .join(words.select("word", "c", "score"), "word").groupBy("row")
            .agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("r_known"),
                 F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("r_base"), *per_class))
    whole = (parts.where(F.col("word").isNull()).select("row", "doc_id", "held_out", "n", "n_known", "base", "score")
             .join(rare, "row", "left"))

    prior = np.log10((documents + 1e-3) / (documents + 1e-3).sum())
    logs = [F.lit(float(prior[k])) + F.col("score")[k] + F.coalesce(f"s{k}", F.lit(0.0)) for k in range(k_all)]
    top_log = F.greatest(*logs) if k_all > 1 else logs[0]
    spread = F.log10(sum((F.pow(F.lit(10.0), x - top_log) for x in logs[1:]), F.pow(F.lit(10.0), logs[0] - top_log)))
    each = math.log10(n_train + v_train + 1)
    return whole.select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"),
        (F.col("n_known") + F.coalesce("r_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("r_base", F.lit(0.0)) - F.col("n") * F.lit(each)).alias("base_score"),
        (top_log + spread).alias("score"))
