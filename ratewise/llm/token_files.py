"""Token-id output as flat binary files with 64-bit document offsets.

Documents are range-partitioned and sorted by doc_id; each task encodes its
run and streams it to one shard in the shared folder:

* ``<shard>.bin``  token ids, unsigned 16 or 32-bit little endian, no header
* ``<shard>.idx``  64-bit document offsets into the shard (one more than documents)
* ``<shard>.ids``  64-bit doc_ids

A shard is written under a temporary name and moved into place, so a task
that runs again writes the same shard again.  The manifest has one row per
shard; a prefix sum over it gives each shard's base, so a document's global
start is base + offset.  The reader maps the files into memory (storage that
can't be mapped is read).

Defined results: null and empty texts hold only the end id; documents with
equal doc_id are ordered by text hash and all written; a null doc_id comes
first and reads back as null; extra columns are ignored; no documents, no shards.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ratewise.llm.common import cut, posix_uri, scratch_path, slices, spread
from ratewise.llm.tokens import shared_encoder

END_ID = 2
SLICE_BYTES = 1 << 20
NO_DOC_ID = -(1 << 63)  # stands for a null doc_id in .ids files
MANIFEST = "shard bigint, n_docs bigint, n_tokens bigint, width int"


def id_type(vocabulary: int) -> str:
    """The narrowest unsigned type that holds all ids."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _file_system(uri: str):
    from pyarrow.fs import FileSystem
    return FileSystem.from_uri(posix_uri(uri))


def vocabulary_size(tokenizer_path: str) -> int:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True)


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write the shards into ``folder`` (a shared folder); returns the manifest
    (shard, n_docs, n_tokens, width, base), already written."""
    kind = id_type(max(vocabulary_size(tokenizer_path), end_id + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        fs.create_dir(base, recursive=True)
        shard, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        name, part = f"{base}/{shard:08d}", f"{base}/_{shard:08d}-{attempt}"
        encoder, end = None, np.array([end_id], dtype=kind).tobytes()
        lengths, doc_ids = [], []
        out = None
        for batch in batches:
            for a, b in slices(batch, "text", SLICE_BYTES):
                rows = batch.slice(a, b - a)
                if out is None:
                    encoder, out = shared_encoder(tokenizer_path, kind), fs.open_output_stream(f"{part}.bin")
                coded = encoder.encode(rows.column("text").to_pylist())
                out.write(b"".join(x + end for x in coded))
                lengths += [(len(x) + len(end)) // len(end) for x in coded]
                doc_ids += [NO_DOC_ID if i is None else i for i in rows.column("doc_id").to_pylist()]
        if out is None:
            return
        out.close()
        offsets = np.concatenate([[0], np.cumsum(np.array(lengths, dtype="<i8"))]).astype("<i8")
        for ending, data in (("idx", offsets), ("ids", np.array(doc_ids, dtype="<i8"))):
            with fs.open_output_stream(f"{part}.{ending}") as f:
                f.write(data.tobytes())
        for ending in ("bin", "idx", "ids"):
            fs.move(f"{part}.{ending}", f"{name}.{ending}")
        yield pa.record_batch([pa.array([shard], pa.int64()), pa.array([len(lengths)], pa.int64()),
                               pa.array([int(offsets[-1])], pa.int64()), pa.array([len(end)], pa.int32())],
                              names=["shard", "n_docs", "n_tokens", "width"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    shards = cut(source.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, MANIFEST), "manifest")
    # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _array(fs, path: str, kind: str) -> np.ndarray:
    """The file as an array: mapped where the storage is a mounted folder."""
    if fs.type_name == "local":
        return np.memmap(path, dtype=kind, mode="r") if fs.get_file_info(path).size else np.zeros(0, dtype=kind)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=kind)


def read_token_files(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32 (of the
    ids as unsigned 32-bit little endian) and, if asked for, ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base_path = _file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{base_path}/{row['shard']:08d}"
                ids = _array(fs, f"{name}.bin", f"<u{row['width']}")
                offsets, docs = _array(fs, f"{name}.idx", "<i8"), _array(fs, f"{name}.ids", "<i8")
                for a in range(0, len(docs), 4096):
                    b = min(a + 4096, len(docs))
                    coded = [ids[offsets[k]:offsets[k + 1]].astype("<u4").tobytes() for k in range(a, b)]
                    doc_id = pa.array(docs[a:b], mask=np.asarray(docs[a:b] == NO_DOC_ID))
                    columns = [doc_id, pa.array(offsets[a:b] + row["base"]), pa.array(np.diff(offsets[a:b + 1])),
                               pa.array([zlib.crc32(x) for x in coded], pa.int64())]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in coded], pa.list_(pa.int64())))
                    yield pa.record_batch(columns, names=names + ["ids"] * with_ids)
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    shards, n_bytes = manifest.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("n_tokens") * F.col("width")), F.lit(0))).first()
    return spread(manifest, shards, n_bytes, "shard").mapInArrow(run, schema)


def token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the files (to a new scratch folder by default) and read them back."""
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer_path, end_id), folder)
