"""Vector codes by product quantisation, with an exact early-out search.

Vectors are cut into equal parts; each part position has a codebook.  Parts
and entries are padded with zeros to a power of two ``n`` and go through the
integer Walsh-Hadamard transform, rows in sequency order (fewest sign changes
first, where smooth parts have most of their energy).  The transform keeps
squared distances up to the factor ``n``, so squared differences are added up
coefficient by coefficient as integers, and an entry is out as soon as its sum
exceeds the whole distance of an entry already known.  What is left is
compared exactly: no floating point, ties to the lower index.

A round is one pass: each task adds up its parts per (position, entry) and
sends one row for each, whatever it read; codebooks (positions x entries x
part length numbers, all parameters but the part length) go to the tasks with
the function.

Defined results: rows whose vector is null or holds a null or non-finite
component are left out; vectors shorter than the longest, or than a multiple
of the number of parts, count as padded with zeros at their end; repeated
rows are vectors of their own; null vec_ids come last when the codebooks
start, equal ones in the order of their components; with fewer vectors than
entries each is one; null labels are one label; no vectors, no rows; extra
columns are ignored.  Components so large that a scaled distance doesn't fit 64
bits raise ``ValueError``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import cut, join_spread

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BATCH_NUMBERS = 1 << 20  # numbers of vectors handled at a time
CODES = "vec_id bigint, none boolean, value {label}, code string, error bigint"


def integer_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): the usable vectors, ``v`` = floor(scale * component)."""
    usable = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return (table.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").where(usable)
            .select("vec_id", "label", v.alias("v")))


def sequency_order(n: int) -> np.ndarray:
    """Rows of the natural-order transform, fewest sign changes first."""
    h = np.ones((1, 1), dtype=np.int64)
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")


def walsh_hadamard(parts: np.ndarray) -> np.ndarray:
    """Transform of the rows, zero-padded to a power of two, in sequency order."""
    m, d = parts.shape
    n = 1 << max(0, d - 1).bit_length()
    t = np.zeros((m, n), dtype=np.int64)
    t[:, :d] = parts
    half = 1
    while half < n:
        pairs = t.reshape(m, n // (2 * half), 2, half)
        t = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(m, n)
        half *= 2
    return t[:, sequency_order(n)]


def nearest_entries(parts: np.ndarray, entries: np.ndarray, work: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row (ties: lower) and its squared
    distance.  ``work``, if given, gets the number of squares added up."""
    t, e = walsh_hadamard(parts), walsh_hadamard(entries)
    n = t.shape[1]
    first = (t[:, :1] - e[:, 0]) ** 2
    bound = ((t - e[first.argmin(axis=1)]) ** 2).sum(axis=1)  # the whole scaled distance of one entry
    row, entry = np.nonzero(first <= bound[:, None])
    sums = first[row, entry]
    squares = first.size + t.size
    for c in range(1, n):
        sums += (t[row, c] - e[entry, c]) ** 2
        squares += len(row)
        stay = sums <= bound[row]
        if not stay.all():
            row, entry, sums = row[stay], entry[stay], sums[stay]
    # rows are still in order and none has lost all its entries
    heads = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(sums, heads) if len(heads) else sums
    best = np.flatnonzero(sums == least[row])
    best = best[np.flatnonzero(np.diff(row[best], prepend=-1))]  # the first of a row has the lowest index
    if work is not None:
        work.append(squares)
    return entry[best], least // n


def largest_component(width: int, parts: int) -> int:
    """The magnitude ``m`` up to which the scaled distance of a part and the
    error of a vector fit a long; ``width`` is the padded part length."""
    # a difference is 2m at most; the scaled distance is width * (width * (2m)^2), with room for
    # one transformed coefficient alone, (width * 2m)^2; the error is parts * width * (2m)^2
    return (math.isqrt(((1 << 63) - 1) // max(width ** 3, width * parts)) - 1) // 2


def _blocks(batch: pa.RecordBatch, parts: int, d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows with their parts as (rows, parts, d), shorter vectors padded."""
    size = max(1, BATCH_NUMBERS // (parts * d))
    for a in range(0, batch.num_rows, size):
        rows = batch.slice(a, size)
        v = rows.column("v")
        lengths = np.diff(v.offsets.to_numpy())
        flat = v.flatten().to_numpy(zero_copy_only=False)
        out = np.zeros((rows.num_rows, parts * d), dtype=np.int64)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(np.arange(rows.num_rows), lengths), at] = flat
        yield rows, out.reshape(-1, parts, d)


def start_codebooks(vectors: DataFrame, parts: int, entries: int, d: int) -> np.ndarray:
    first = vectors.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    out = np.zeros((len(first), parts * d), dtype=np.int64)
    for k, r in enumerate(first):
        out[k, :len(r.v)] = r.v
    return out.reshape(len(first), parts, d).transpose(1, 0, 2).copy()  # (part, entry, position)


def moved(vectors: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round: componentwise floor of the exact mean."""
    parts, entries, d = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), dtype=np.int64)
        sums = np.zeros((parts, entries, d), dtype=np.int64)
        for batch in batches:
            for _, x in _blocks(batch, parts, d):
                for p in range(parts):
                    entry, _ = nearest_entries(x[:, p], codebooks[p])
                    counts[p] += np.bincount(entry, minlength=entries)
                    np.add.at(sums[p], entry, x[:, p])
        part, entry = np.nonzero(counts)
        columns = [pa.array(part), pa.array(entry), pa.array(counts[part, entry])]
        columns += [pa.array(sums[part, entry, i]) for i in range(d)]
        yield pa.record_batch(columns, names=["part", "entry", "n", *(f"s{i}" for i in range(d))])
    schema = "part bigint, entry bigint, n bigint, " + ", ".join(f"s{i} bigint" for i in range(d))
    added = vectors.select("v").mapInArrow(run, schema).groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(d)))
    out = codebooks.copy()
    for r in added.collect():  # parts x entries rows at most
        out[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(d)]
    return out


def coded(vectors: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """vec_id, none (no label), value (label), code, error."""
    parts, _, d = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _blocks(batch, parts, d):
                found = [nearest_entries(x[:, p], codebooks[p]) for p in range(parts)]
                code = ["".join(f"{k:02x}" for k in ks) for ks in np.stack([k for k, _ in found], axis=1).tolist()]
                error = sum(e for _, e in found)
                yield pa.record_batch([rows.column("vec_id"), rows.column("none"), rows.column("value"),
                                       pa.array(code, pa.string()), pa.array(error)],
                                      names=["vec_id", "none", "value", "code", "error"])
    label = vectors.schema["label"].dataType.simpleString()
    source = vectors.select("vec_id", F.col("label").isNull().alias("none"), F.col("label").alias("value"), "v")
    return source.mapInArrow(run, CODES.format(label=label))


def codebooks_digest(codebooks: np.ndarray, length: int) -> str:
    """sha256 of the integers by part, entry, position (``length`` 0: none)."""
    numbers = codebooks.reshape(-1).tolist() if length else []
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def vector_codes(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 scale: int = SCALE) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256: one row per
    usable vector.  ``entries`` is at most 256 (two hex digits)."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    spark = table.sparkSession
    vectors = cut(integer_vectors(table, scale), "vectors")
    length, top, low = vectors.agg(F.max(F.size("v")), F.max(F.array_max("v")), F.min(F.array_min("v"))).first()
    label = vectors.schema["label"].dataType.simpleString()
    if length is None:
        return spark.createDataFrame([], f"vec_id bigint, label {label}, code string, error bigint, label_error bigint, "
                                         "codebooks_sha256 string")
    d = max(1, -(-length // parts))
    limit = largest_component(1 << (d - 1).bit_length(), parts)
    if length and max(top, -low) > limit:
        raise ValueError(f"a component beyond {limit} / {scale}: scaled distances don't fit 64 bits")
    codebooks = start_codebooks(vectors, parts, entries, d)
    for _ in range(rounds):
        codebooks = moved(vectors, codebooks)
    codes = coded(vectors, codebooks)
    # a null label has a key too; labels can be many and one can be hot
    codes = cut(codes.withColumn("key", F.when(F.col("none"), "").otherwise(F.col("value").cast("string"))), "codes")
    totals = cut(codes.groupBy("none", "key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "labels")
    return join_spread(codes, totals, ["none", "key"], "n").select(
        "vec_id", F.col("value").alias("label"), "code", "error", "label_error",
        F.lit(codebooks_digest(codebooks, length)).alias("codebooks_sha256"))
