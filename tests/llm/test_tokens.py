import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratewise.llm import common, packing, token_counts, token_files
from ratewise.llm.common import cut, global_rank
from ratewise.llm.queries import BPE
from ratewise.llm.tokens import PieceEncoder, _Memo


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def strange():
    rnd = random.Random(1)
    parts = [*" '\n\tsatreévmld09 .,<>|é　\x1c\x85你🙂ǅ²½ßÄ", "<|endoftext|>", "  ", "'s", "'re", " 12", "Über", "word"]
    return ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(20_000)]


def test_pieces_equal_the_library(library, strange):
    got = PieceEncoder(BPE, limit=100_000).encode(strange)
    want = library.encode_batch(strange, add_special_tokens=False)
    assert all(np.frombuffer(a, "<u4").tolist() == b.ids for a, b in zip(got, want))


@pytest.mark.parametrize("unit", ["ab1", "é", "word!", "北京", "x" * 40 + "."])
def test_unbroken_texts_equal_the_library_and_are_not_remembered(library, unit):
    """A text without spaces is one piece; memory stays within the limit."""
    encoder = PieceEncoder(BPE)
    for n in (200, 20_000):
        text = unit * n
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert all(len(k) <= 128 for memo in (encoder._pieces, encoder._words) for k in memo)


def test_memo_is_bounded_by_bytes():
    made = []
    memo = _Memo(lambda t: made.append(t) or t.encode(), 40_000)
    for k in range(1000):
        memo[f"piece {k}"]
        assert memo._bytes <= 20_000
    assert len(made) == 1000 and len(memo) + len(memo._older) < 200
    memo["piece 999"]
    assert len(made) == 1000  # remembered


def test_transducer_equals_the_library(library, strange):
    texts = [*strange[:3000], " ".join(strange), None]
    got = token_counts.CountTransducer(BPE, chunk=7).counts(texts)
    assert got == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_scan_composes_state_maps():
    rnd = np.random.default_rng(3)
    exits, counts = rnd.integers(0, 3, (50, 3)), rnd.integers(0, 9, (50, 3))
    heads = rnd.random(50) < 0.2
    heads[0] = True
    got_exit, got_count = token_counts.compose_scan(exits, counts, heads)
    for entry in range(3):
        for k in range(50):
            if heads[k]:
                state, total = entry, 0
            total += counts[k, state]
            state = exits[k, state]
            assert (got_exit[k, entry], got_count[k, entry]) == (state, total)


def _ids(library, docs, end):
    return [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [end]) for r in docs.collect()]


def test_token_counts(library, odd_docs, no_docs, rows_of):
    want = [(r.doc_id, len((r.text or "").encode()), n, n > 512) for r in odd_docs.collect()
            for n in [len(library.encode(r.text or "", add_special_tokens=False).ids)]]
    got = rows_of(token_counts.token_counts(odd_docs, BPE), "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert got == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert token_counts.token_counts(no_docs, BPE).count() == 0


def test_token_files_round_trip(library, odd_docs, no_docs):
    got = token_files.token_files(odd_docs, BPE).collect()
    want = _ids(library, odd_docs, 2)
    crc = lambda ids: zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    key = lambda x: (x[0] is not None, x[0] or 0)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=lambda x: (key(x), x[1:])) == sorted(
        ((i, len(ids), crc(ids)) for i, ids in want), key=lambda x: (key(x), x[1:]))
    at = 0
    for r in sorted(got, key=lambda r: r.start):  # gapless, in ascending doc_id order, nulls first
        assert r.start == at
        at += r.n_tokens
    order = [key((r.doc_id,)) for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    assert token_files.token_files(no_docs, BPE).count() == 0


def test_wide_and_narrow_ids():
    assert token_files.id_type(1 << 16) == "<u2" and token_files.id_type((1 << 16) + 1) == "<u4"


def test_fullest_equals_brute_force():
    rnd = random.Random(4)
    for _ in range(200):
        room = rnd.randint(1, 60)
        available = sorted(((k, rnd.randint(1, 4)) for k in rnd.sample(range(1, 40), rnd.randint(1, 6))), reverse=True)
        reach = {0}
        for k, n in available:
            reach = {s + k * m for s in reach for m in range(n + 1) if s + k * m <= room}
        used = packing.fullest(available, room)
        assert sum(k * m for k, m in used.items()) == max(reach)
        assert all(m <= dict(available)[k] for k, m in used.items())


def test_packing(library, odd_docs, no_docs):
    rows = packing.packed_documents(odd_docs, BPE, capacity=256, with_ids=True).cache()
    want = sorted((str(i), ids) for i, ids in _ids(library, odd_docs, 0))
    whole, bins = {}, {}
    pieces = sorted(rows.collect(), key=lambda r: (str(r.doc_id), r.start))
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length <= 256 and zlib.crc32(r.ids) == r.ids_crc32
        assert r.length == 256 or r.piece == 0  # only the first piece may be shorter
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        whole[(str(r.doc_id), r.start)] = whole.get((str(r.doc_id), r.start), 0) + 1
    for slots in bins.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(len(ids) for _, ids in want)
    assert sum(r.length for r in pieces) == total
    # one document row with its ids, joined from its pieces
    one = next(ids for i, ids in want if i == "12")
    assert sum((np.frombuffer(r.ids, "<u4").tolist() for r in pieces if r.doc_id == 12), []) == one
    assert len(bins) <= -(-total // 256) + 2
    joined = packing.sequences(rows).collect()
    assert {r.sequence_id: r.length for r in joined} == {k: sum(n for _, n in v) for k, v in bins.items()}
    assert all(len(r.ids) == 4 * r.length for r in joined)
    assert packing.packed_documents(no_docs, BPE).count() == 0


def test_equal_keys_are_ranked_in_many_partitions(spark, monkeypatch):
    """A third of the rows equal in every key."""
    sorted_rows = []
    monkeypatch.setattr(common, "cut", lambda df, name: sorted_rows.append(cut(df, name)) or sorted_rows[-1])
    rows = cut(spark.range(30_000).repartition(4).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"), F.lit(None).cast("long").alias("_place")))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"  # the rows are too few for more than one
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        ranked = global_rank(rows, ["k"], "r", ties=True)
    finally:
        spark.conf.set(setting, before)
    assert ranked.columns == ["k", "_place", "r"]
    got = [(r.r, r.k) for r in ranked.collect()]
    assert sorted(r for r, _ in got) == list(range(30_000))
    assert [k for _, k in sorted(got)] == sorted(k for _, k in got)
    sizes = sorted_rows[0].where("k = 7").groupBy("_pid").count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 8_000
