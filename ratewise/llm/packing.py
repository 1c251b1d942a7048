"""Best-fit packing by minimum bin slack.

Documents become token ids plus an end id; only documents longer than a
sequence are cut, from their end, so that all pieces but the first are full.

Bins are filled one at a time: the longest piece left opens the bin, and a
bitset subset-sum over the available lengths finds the fullest feasible
combination, which is then removed.  Pieces of equal length are
interchangeable, so the search works on the histogram of lengths (at most
``capacity`` numbers, whatever the corpus), and a combination is removed as
often as the counts allow before the next search.  Pieces are then dealt to
the slots of the plan by their global rank in (length, doc_id, piece) order:
closed arithmetic on a binary search in the plan, no group of equal lengths
ever meets in one task.

Defined results: a null or empty text is its end id alone, so every document
row has at least one piece; repeated rows are packed as separate pieces;
extra columns are ignored; no documents, no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import cut, fresh, global_rank, slices
from ratewise.llm.tokens import shared_encoder

CAPACITY = 2048
END_ID = 0
SLICE_BYTES = 1 << 20


def fullest(available: list[tuple[int, int]], room: int) -> dict[int, int]:
    """The multiset of (length, count) filling ``room`` the most: length -> uses.

    Bit ``s`` of the set is on if some combination of the lengths so far sums
    to ``s``.  A count enters as 1, 2, 4, ... copies (and the rest); longer
    lengths first; the search ends once the room can be filled exactly."""
    full, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length, count in available:
        if length > room:
            continue
        count, copies = min(count, room // length), 1
        while count > 0:
            take = min(copies, count)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            count -= take
            copies *= 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:  # the sum needs this step
            used[length] = used.get(length, 0) + take
            at -= length * take
    return used


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bins, [(length, pieces per bin), ...]) until every piece has a place."""
    left, plan = {k: n for k, n in counts.items() if n}, []
    order = sorted(left, reverse=True)
    while left:
        order = [k for k in order if k in left]
        longest = order[0]
        inside = fullest([(k, left[k] - (k == longest)) for k in order], capacity - longest)
        inside[longest] = inside.get(longest, 0) + 1
        bins = min(left[k] // m for k, m in inside.items())
        for k, m in inside.items():
            left[k] -= m * bins
            if not left[k]:
                del left[k]
        plan.append((bins, sorted(inside.items(), reverse=True)))
    return plan


def _slots(plan, counts: dict[int, int]) -> dict[str, np.ndarray]:
    """The plan as intervals of global ranks (pieces sorted by length)."""
    lengths = sorted(counts)
    begin = dict(zip(lengths, np.concatenate([[0], np.cumsum([counts[k] for k in lengths])])[:-1].tolist()))
    rows, sequence = [], 0
    for bins, inside in plan:
        offset = 0
        for k, m in inside:
            rows.append((begin[k], k, m, sequence, offset))
            begin[k] += m * bins
            offset += k * m
        sequence += bins
    rows.sort()
    return {n: np.array(c, dtype=np.int64) for n, c in zip(("start", "length", "uses", "sequence", "offset"), zip(*rows))}


def pack(pieces: DataFrame, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece"),
         capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a cut table) plus sequence_id and offset.  Every length is
    between 1 and ``capacity``; ``order`` breaks ties between equal lengths."""
    counts = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}  # at most ``capacity`` rows
    if any(k < 1 or k > capacity for k in counts):
        raise ValueError(f"piece lengths must be between 1 and {capacity}")
    (rank,) = fresh(pieces, "_rank")
    ranked = global_rank(pieces, [length, *order], rank, ties=True)
    if not counts:
        return ranked.drop(rank).withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    slots = pieces.sparkSession.sparkContext.broadcast(_slots(plan_bins(counts, capacity), counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = slots.value
        for batch in batches:
            at = batch.column(rank).to_numpy()
            k = np.searchsorted(s["start"], at, side="right") - 1
            bins, slot = np.divmod(at - s["start"][k], s["uses"][k])
            out = batch.drop_columns([rank])
            out = out.append_column("sequence_id", pa.array(s["sequence"][k] + bins))
            yield out.append_column("offset", pa.array(s["offset"][k] + slot * s["length"][k]))
    schema = ranked.drop(rank).withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    return ranked.mapInArrow(run, schema)


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY,
                 with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 and, if asked for,
    ``ids`` (unsigned 32-bit little endian)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = None, np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            encoder = encoder or shared_encoder(tokenizer_path)
            for a, b in slices(batch, "text", SLICE_BYTES):
                rows, out = batch.slice(a, b - a), []
                for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encoder.encode(rows.column("text").to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                    for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        data = ids[4 * x:4 * y]
                        out.append((doc_id, k, x, y - x, zlib.crc32(data), data if with_ids else None))
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                n = len(names) if with_ids else len(names) - 1
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns[:n], kinds)], names=names[:n])
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def packed_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY,
                     with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset."""
    return pack(cut(token_pieces(docs, tokenizer_path, end_id, capacity, with_ids), "pieces"), capacity=capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length, ids: the packed training rows (``packed`` with
    ids).  A group holds one sequence, at most ``capacity`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda x, y: F.concat(x, y["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
