"""WARC archives, written and read back by boundary-chain verification.

Writing: each task streams its pages to one uncompressed archive in the
shared folder, under a temporary name that is moved into place.  Of records
with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the
largest page_id is a response; the others are revisits that refer to it.

Reading: archives are cut into byte blocks.  A task finds in its block every
place that looks like a record (magic after a blank line, a complete header,
a length that ends inside the file) and emits the candidate's successor: the
offset at which the next record must begin.  Payloads may hold magic, whole
fake records even, so a candidate counts only if a chain of successors leads
to it from the start of its file.  Chains inside a block are followed by
pointer jumping in the task, chains between blocks by pointer jumping in
log2(blocks of a file) joins.  Records are then read from the verified
entries of each block.

Defined results: null html is an empty payload, a null url an empty target;
rows with a null page_id are responses that nothing refers to; rows equal to
the response in page_id and payload are responses too; empty tables make no
archive; a record whose length runs past the end of its file is no record;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import cut, join_spread, posix_uri, scratch_path, spread

REVISIT_BYTES = 1000
BLOCK_BYTES = 8 << 20
DATE = "2000-01-01T00:00:00Z"  # the tables hold no time
HEADER_READ = 4 << 10

# fixed values of the WARC 1.0 format
MAGIC = b"WARC/1.0\r\n"
BLANK = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"


def _file_system(uri: str):
    from pyarrow.fs import FileSystem
    return FileSystem.from_uri(posix_uri(uri))


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    name = f"{RECORD_ID}{'' if page_id is None else page_id}"
    head = ["WARC/1.0", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {re.sub(r'[\r\n]+', ' ', url)}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{RECORD_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + BLANK + block + BLANK


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, content, refers_to) of the rows that become revisits.
    ``pages``: page_id, content (SHA-256 of the payload), payload_bytes."""
    large = cut(pages.where((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull())
                .select("page_id", "content"), "large")
    groups = cut(large.groupBy("content").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
                 .where("n > 1"), "groups")
    return (join_spread(large, groups, ["content"], "n").where("page_id != refers_to")
            .select("page_id", "content", "refers_to").distinct())


def write_archives(pages: DataFrame, folder: str, least: int = REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) into ``folder``; returns the
    manifest (file, n_bytes, n_records), already written."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                         payload.alias("payload"))
            .withColumns({"content": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload")}))
    again = cut(revisits(rows.drop("payload", "url"), least), "revisits")
    source = (rows.join(again, ["page_id", "content"], "left")
              .select("page_id", "url", "payload", F.sha1("payload").alias("digest"), "refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        fs.create_dir(base, recursive=True)
        name = f"{TaskContext.get().partitionId():08d}.warc"
        part, out, n, size = f"{base}/_{name}-{uuid.uuid4().hex}", None, 0, 0
        for batch in batches:
            out = out or (fs.open_output_stream(part) if batch.num_rows else None)
            for row in range(batch.num_rows):
                data = record(*(batch.column(c)[row].as_py() for c in range(5)))
                out.write(data)
                n, size = n + 1, size + len(data)
        if out is not None:
            out.close()
            fs.move(part, f"{base}/{name}")
            yield pa.record_batch([pa.array([name]), pa.array([size], pa.int64()), pa.array([n], pa.int64())],
                                  names=["file", "n_bytes", "n_records"])
    return cut(source.mapInArrow(run, "file string, n_bytes bigint, n_records bigint"), "manifest")


def _header(read, at: int, size: int) -> tuple[dict[str, str], int] | None:
    """Header fields of the record at ``at`` and the offset of its block."""
    want = HEADER_READ
    while True:
        data = read(at, min(want, size - at))
        end = data.find(BLANK)
        if end >= 0:
            break
        if at + len(data) >= size:
            return None
        want *= 4
    lines = data[len(MAGIC):end].decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, at + end + len(BLANK)


def _successor(read, at: int, size: int) -> int | None:
    """The offset after the record that ``at`` may be the start of."""
    found = _header(read, at, size)
    if found is None or not re.fullmatch(r"[0-9]{1,18}", found[0].get("content-length", "")):
        return None
    after = found[1] + int(found[0]["content-length"]) + len(BLANK)
    return after if after <= size else None


def _reader(fs, path: str):
    f = fs.open_input_file(path)
    return lambda at, n: f.read_at(n, at)


def jump_inside(starts: np.ndarray, after: np.ndarray, end: int) -> np.ndarray:
    """Where each chain leaves the block: its first offset at or beyond
    ``end``, or -1 if it breaks off at a place that is no candidate.  Pointer
    jumping."""
    if not len(starts):
        return after
    after = after.copy()
    while True:
        inside = np.flatnonzero((after >= 0) & (after < end))
        if not len(inside):
            return after
        at = np.searchsorted(starts, after[inside])
        known = (at < len(starts)) & (starts[np.minimum(at, len(starts) - 1)] == after[inside])
        after[inside] = np.where(known, after[np.minimum(at, len(starts) - 1)], -1)


def candidates(blocks: DataFrame, folder: str) -> DataFrame:
    """(file, start, leaves): every candidate of every block and where its
    chain leaves the block.  ``blocks``: file, n_bytes, first, last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        for batch in batches:
            for b in batch.to_pylist():
                read, size = _reader(fs, f"{base}/{b['file']}"), b["n_bytes"]
                low = max(0, b["first"] - len(BLANK))
                data = read(low, min(size, b["last"] + len(MAGIC)) - low)

                def near(at, n, data=data, low=low, read=read):
                    """From the block where it holds the bytes, else from the file."""
                    return data[at - low:at - low + n] if at - low + n <= len(data) else read(at, n)
                starts, after = [], []
                for m in re.finditer(re.escape(MAGIC), data):
                    at = low + m.start()
                    if b["first"] <= at < b["last"] and (at == 0 or data[m.start() - len(BLANK):m.start()] == BLANK):
                        then = _successor(near, at, size)
                        if then is not None:
                            starts.append(at)
                            after.append(then)
                starts, after = np.array(starts, dtype=np.int64), np.array(after, dtype=np.int64)
                leaves = jump_inside(starts, after, b["last"])
                yield pa.record_batch([pa.array([b["file"]] * len(starts), pa.string()), pa.array(starts), pa.array(leaves)],
                                      names=["file", "start", "leaves"])
    return blocks.mapInArrow(run, "file string, start bigint, leaves bigint")


def _sizes(manifest: DataFrame, block_bytes: int) -> tuple[int, int, int]:
    """Bytes of the largest file, bytes of all, number of blocks."""
    n = F.col("n_bytes")
    got = manifest.agg(F.max(n), F.sum(n), F.sum(F.ceil(n / F.lit(block_bytes)))).first()
    return tuple(int(x or 0) for x in got)


def verified_entries(manifest: DataFrame, folder: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, n_bytes, start): for each block that a record begins in, the
    first record reachable from the start of the file."""
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bytes") - 1, F.lit(block_bytes).cast("long")))
    blocks = manifest.where("n_bytes > 0").select("file", "n_bytes", first.alias("first")).withColumn(
        "last", F.least(F.col("first") + block_bytes, F.col("n_bytes")))
    sizes = manifest.select("file", "n_bytes")
    # the chain's start is a candidate like any other: a file that begins otherwise has no records
    most, total, n_blocks = _sizes(manifest, block_bytes)
    found = cut(candidates(spread(blocks, n_blocks, total, "file", "first"), folder), "candidates")
    reached = found.where("start = 0").select("file", "start")
    hops = -(-most // block_bytes)  # blocks of the largest file
    if hops > 1:
        # only candidates that a chain enters a block by can be on the way
        entered = found.select("file", F.col("leaves").alias("start")).distinct()
        jump = cut(found.join(entered, ["file", "start"], "left_semi").unionByName(found.where("start = 0")).distinct(), "jump")
        done = 1
        while True:
            # reached: the first ``done`` entries of each chain; jump: over ``done`` entries
            nxt = reached.join(jump, ["file", "start"]).select("file", F.col("leaves").alias("start"))
            reached = cut(reached.unionByName(nxt.join(found.select("file", "start"), ["file", "start"], "left_semi")), "reached")
            done *= 2
            if done >= hops:
                break
            ahead = jump.select("file", F.col("start").alias("leaves"), F.col("leaves").alias("further"))
            jump = cut(jump.join(ahead, ["file", "leaves"]).select("file", "start", F.col("further").alias("leaves")), "jump")
    return reached.join(sizes, "file").select("file", "n_bytes", "start")


def read_records(manifest: DataFrame, folder: str, block_bytes: int = BLOCK_BYTES, with_payload: bool = False) -> DataFrame:
    """One row per verified record: file, start, page_id, record_type,
    payload_bytes, payload_digest, refers_to, target_uri[, payload].  A
    revisit has no payload; its digest is the header's."""
    kinds = [("file", pa.string()), ("start", pa.int64()), ("page_id", pa.int64()), ("record_type", pa.string()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string())]
    kinds += [("payload", pa.binary())] * with_payload

    def number(field: str) -> int | None:
        digits = field.strip("<>").removeprefix(RECORD_ID)
        return int(digits) if digits else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        for batch in batches:
            for b in batch.to_pylist():
                read, size, at, out, held = _reader(fs, f"{base}/{b['file']}"), b["n_bytes"], b["start"], [], 0
                end = min(size, (at // block_bytes + 1) * block_bytes)
                data, low = read(at, end - at), at

                def near(where, n, data=data, low=low, read=read):
                    return data[where - low:where - low + n] if where - low + n <= len(data) else read(where, n)
                # the chain may break off: at what is no record, or at one cut short
                while at < end and near(at, len(MAGIC)) == MAGIC and _successor(near, at, size) is not None:
                    fields, block = _header(near, at, size)
                    n = int(fields["content-length"])
                    head, _, payload = near(block, n).partition(BLANK)
                    if fields["warc-type"] == "revisit":
                        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                        length = int(re.search(rb"(?i)content-length: *([0-9]+)", head)[1])
                    else:
                        digest, length = hashlib.sha1(payload).hexdigest(), len(payload)
                    out.append((b["file"], at, number(fields["warc-record-id"]), fields["warc-type"], length, digest,
                                number(fields.get("warc-refers-to", "")), fields["warc-target-uri"], payload)[:len(kinds)])
                    at, held = block + n + len(BLANK), held + (n if with_payload else 500)
                    if held > 4 << 20:
                        yield pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*out), kinds)], names=[k for k, _ in kinds])
                        out, held = [], 0
                if out:
                    yield pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*out), kinds)], names=[k for k, _ in kinds])
    names = {"string": "string", "int64": "bigint", "binary": "binary"}
    _, total, n_blocks = _sizes(manifest, block_bytes)
    entries = spread(verified_entries(manifest, folder, block_bytes), n_blocks, total, "file", "start")
    return entries.mapInArrow(run, ", ".join(f"{k} {names[str(t)]}" for k, t in kinds))


def warc_round_trip(pages: DataFrame, folder: str | None = None, least: int = REVISIT_BYTES,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, as read
    back from the archives written into ``folder`` (scratch by default)."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder, least), folder, block_bytes).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
