import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import token_files, warc
from ratewise.llm.common import scratch_path, spread
from ratewise.llm.queries import BPE

COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def brute(rows):
    keep = defaultdict(list)
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and i is not None:
            keep[data].append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        best = max(keep[data], default=i) if len(data) >= 1000 and i is not None else i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if best == i else "revisit", None if best == i else best))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    fake = warc.record(9, "http://x", b"fake payload", hashlib.sha1(b"fake payload").hexdigest(), None).decode()
    html = ["", None, "short", "short", "<p>" + "größe " * 300, "<p>" + "größe " * 300, f"lead\r\n\r\n{fake}tail",
            f"\r\n\r\n{fake}{fake}", "WARC/1.0\r\n", "x\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\n", "y" * 50_000,
            f"{'pad' * 700}\r\n\r\n{fake}" * 3, f"{'pad' * 700}\r\n\r\n{fake}" * 3, "a" * 999, "a" * 999, "a" * 1000, "a" * 1000]
    html += ["z" * rnd.randint(0, 3000) for _ in range(60)] + ["copied page " * 200] * 40
    out = [(i, f"http://h/{i}\r\nX: y", h) for i, h in enumerate(html)]
    return out + [(None, None, "copied page " * 200), (5, "u", "<p>" + "größe " * 300), (None, None, None)]


@pytest.fixture(scope="module")
def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(3)


@pytest.mark.parametrize("block_bytes", [700, 8 << 20])
def test_round_trip(pages, rows, rows_of, block_bytes):
    assert rows_of(warc.warc_round_trip(pages, block_bytes=block_bytes), *COLUMNS) == brute(rows)


def test_fake_records_are_candidates_but_not_reached(spark, pages, rows):
    folder = scratch_path(spark, "test")
    manifest = warc.write_archives(pages, folder)
    magic = "WARC/1.0\r\n"
    planted = sum((h or "").count(magic) for _, _, h in rows)
    records = warc.read_records(manifest, folder, 4096, with_payload=True).cache()
    assert planted > 10 and records.count() == len(rows)
    whole = {r.page_id: bytes(r.payload).decode() for r in records.where("record_type = 'response'").collect()}
    assert all(whole[i] == (h or "") for i, _, h in rows if i in whole and i is not None)


def test_jumping_inside_a_block():
    starts, after = np.array([0, 10, 25, 40]), np.array([25, 12, 40, 70])
    assert warc.jump_inside(starts, after, 50).tolist() == [70, -1, 70, 70]


def test_truncated_file_and_empty_table(spark, tmp):
    good = warc.record(1, "u", b"one", hashlib.sha1(b"one").hexdigest(), None)
    cut_off = warc.record(2, "u", b"two" * 100, hashlib.sha1(b"two" * 100).hexdigest(), None)[:-50]
    for name, data in (("a.warc", good + cut_off), ("b.warc", b"junk" + good), ("c.warc", b"")):
        with open(f"{tmp}/{name}", "wb") as f:
            f.write(data)
    sizes = [("a.warc", len(good + cut_off), 2), ("b.warc", len(good) + 4, 1), ("c.warc", 0, 0)]
    manifest = spark.createDataFrame(sizes, "file string, n_bytes long, n_records long")
    assert [r.page_id for r in warc.read_records(manifest, tmp).collect()] == [1]
    assert warc.warc_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_read_back_uses_a_task_for_each_shard_or_block(spark, odd_docs):
    """Rows too small for adaptive execution to spread are spread all the same."""
    small = spark.range(40).select(F.col("id").alias("shard"))
    parts = [n for n in spread(small, 40, 0, "shard").rdd.glom().map(len).collect() if n]
    assert len(parts) >= min(8, spark.sparkContext.defaultParallelism) - 1 and max(parts) <= 12
    assert len([n for n in spread(small, 40, 40 << 30, "shard").rdd.glom().map(len).collect() if n]) == 40
    folder = scratch_path(spark, "spread")
    manifest = token_files.write_token_files(odd_docs, folder, BPE)
    back = token_files.read_token_files(manifest, folder)
    used = back.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used == min(manifest.count(), spark.sparkContext.defaultParallelism)
