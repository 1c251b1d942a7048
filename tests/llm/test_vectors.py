"""Centroid clusters and vector codes against plain loops over Python integers."""
import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from ratewise.llm import clusters, vector_codes
from ratewise.llm.common import table

SF001 = "/root/testdata/sf0.001"


def usable(rows, scale, dims=None):
    out = []
    for i, v, label in rows:
        if v is None or (dims is not None and len(v) != dims) or any(x is None or not math.isfinite(x) for x in v):
            continue
        out.append((i, [math.floor(scale * float(np.float32(x))) for x in v], label))
    return out


def nearest(v, entries):
    return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(entries))


def updated(entries, chosen):
    out = list(entries)
    for k, vs in chosen.items():
        out[k] = [sum(c) // len(vs) for c in zip(*vs)]
    return out


def brute_clusters(rows, k=16, rounds=3, dims=64):
    kept = usable(rows, 64, dims)
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v, _ in order[:k]]
    for _ in range(rounds):
        chosen = defaultdict(list)
        for _, v, _ in kept:
            chosen[nearest(v, centroids)[1]].append(v)
        centroids = updated(centroids, chosen)
    placed = [(i, *nearest(v, centroids)) for i, v, _ in kept]
    spent = defaultdict(int)
    for _, d, c in placed:
        spent[c] += d
    return key_sorted((i, c, d, spent[c], sum(spent.values()),
                       hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, d, c in placed)


def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = usable(rows, 4096)
    longest = max(len(v) for _, v, _ in kept)
    d = max(1, -(-longest // parts))
    cut = lambda v: [(v + [0] * (parts * d - len(v)))[p * d:p * d + d] for p in range(parts)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[cut(v)[p] for _, v, _ in order[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            chosen = defaultdict(list)
            for _, v, _ in kept:
                x = cut(v)[p]
                chosen[nearest(x, books[p])[1]].append(x)
            books[p] = updated(books[p], chosen)
    digest = hashlib.sha256((",".join(str(x) for b in books for e in b for x in e) if longest else "").encode()).hexdigest()
    out = []
    for i, v, label in kept:
        best = [nearest(x, books[p]) for p, x in enumerate(cut(v))]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(e for e, _ in best), label))
    total = defaultdict(int)
    for _, _, e, label in out:
        total[label] += e
    return key_sorted((i, c, e, total[label], digest) for i, c, e, label in out)


def key_sorted(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, str(v)) for v in r))


CLUSTER = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
CODE = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, code int, v int, error string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd_vectors():
    """Nulls, non-finite components, ties, repeated rows, null ids and labels,
    a vector that a third of the rows share, and wrong lengths."""
    rnd = random.Random(4)
    v = lambda n=64: [rnd.uniform(-1, 1) for _ in range(n)]
    rows = [(i, v(), rnd.choice([None, 1, 2, 3])) for i in range(80)]
    hot = v()
    rows += [(100 + i, hot, 7) for i in range(40)] + [rows[5], rows[5], (5, v(), None)]
    rows += [(None, v(), 1), (None, None, 1), (200, None, 1), (201, [None] * 64, 1), (202, [float("nan")] + v(63), 2),
             (203, [float("inf")] + v(63), 2), (204, [-1.0] * 64, 2), (205, [0.0] * 64, 2), (206, [-0.0] * 64, None),
             (207, [1e-30, -1e-30] * 32, 1)]
    return rows


def test_clusters_equal_brute_force(spark, odd_vectors):
    short = odd_vectors + [(300, [], 1), (301, [1.0] * 63, 1), (302, [1.0] * 65, 1)]
    got = clusters.centroid_clusters(frame(spark, short).repartition(5))
    assert key_sorted(got.select(*CLUSTER).collect()) == brute_clusters(short)


def test_codes_equal_brute_force(spark, odd_vectors):
    got = vector_codes.vector_codes(frame(spark, odd_vectors).repartition(5))
    assert key_sorted(got.select(*CODE).collect()) == brute_codes(odd_vectors)


def test_codes_of_mixed_lengths(spark, odd_vectors):
    """Shorter vectors count as padded; 66 components are no multiple of 8."""
    mixed = [(i, x if i is None or i % 7 else x and x[:i % 11], k) for i, x, k in odd_vectors] + [(400, [0.5] * 66, 1), (401, [], None)]
    got = vector_codes.vector_codes(frame(spark, mixed).repartition(3))
    assert key_sorted(got.select(*CODE).collect()) == brute_codes(mixed)


@pytest.mark.parametrize("rows", [[(1, [0.25] * 64, None)], [(i, [float(i % 3)] * 64, 1) for i in range(9)]])
def test_fewer_vectors_than_entries(spark, rows):
    assert key_sorted(clusters.centroid_clusters(frame(spark, rows)).select(*CLUSTER).collect()) == brute_clusters(rows)
    assert key_sorted(vector_codes.vector_codes(frame(spark, rows)).select(*CODE).collect()) == brute_codes(rows)


def test_only_empty_vectors(spark):
    got = vector_codes.vector_codes(frame(spark, [(1, [], 1), (2, [], None)])).select(*CODE).collect()
    assert key_sorted(got) == brute_codes([(1, [], 1), (2, [], None)])


def test_no_usable_vectors(spark):
    for rows in ([], [(1, None, 1), (2, [float("nan")] * 64, 1)]):
        assert clusters.centroid_clusters(frame(spark, rows)).collect() == []
        assert vector_codes.vector_codes(frame(spark, rows)).collect() == []


def test_too_large_components_raise(spark):
    rows = [(1, [3e38] * 64, 1), (2, [0.0] * 64, 1)]
    with pytest.raises(ValueError, match="64 bits"):
        clusters.centroid_clusters(frame(spark, rows))
    with pytest.raises(ValueError, match="64 bits"):
        vector_codes.vector_codes(frame(spark, rows))


def test_largest_components_are_exact():
    """At the bound, and with every sign, the scaled sums don't wrap."""
    m = vector_codes.largest_component(8, 8)
    rnd = random.Random(1)
    parts = np.array([[rnd.choice((-m, m)) for _ in range(8)] for _ in range(200)], dtype=np.int64)
    entries = np.array([[rnd.choice((-m, m)) for _ in range(8)] for _ in range(16)] + [[-m] * 8, [m] * 8], dtype=np.int64)
    k, d = vector_codes.nearest_entries(parts, entries)
    want = [nearest(p, entries.tolist()) for p in parts.tolist()]
    assert list(zip(d.tolist(), k.tolist())) == want
    assert 64 * (2 * clusters.largest_component(64)) ** 2 < 1 << 63


def test_transform_keeps_scaled_distances_in_sequency_order():
    rng = np.random.default_rng(0)
    for d in (1, 2, 3, 5, 8, 12, 16):
        x, y = (rng.integers(-1000, 1000, (20, d)) for _ in range(2))
        n = vector_codes.walsh_hadamard(x).shape[1]
        diff = vector_codes.walsh_hadamard(x) - vector_codes.walsh_hadamard(y)
        assert (diff ** 2).sum(axis=1).tolist() == (n * ((x - y) ** 2).sum(axis=1)).tolist()
        rows = vector_codes.walsh_hadamard(np.eye(n, dtype=np.int64)).T  # each row is one Walsh function
        assert (np.diff(rows, axis=1) != 0).sum(axis=1).tolist() == list(range(n))


def test_entries_are_eliminated_early():
    """Smooth parts: most squares are never added up."""
    rng = np.random.default_rng(1)
    parts = rng.integers(-4000, 4000, (500, 1)) + rng.integers(-20, 20, (500, 8))
    work = []
    vector_codes.nearest_entries(parts, parts[:16], work)
    assert work[0] < 500 * 16 * 8 / 2


def test_vectors_never_shuffle(spark):
    """A round deals out sums only: the vectors' scan feeds a partial aggregate."""
    vectors = clusters.integer_vectors(table(spark, SF001, "embeddings"))
    wide = vectors.select(clusters.nearest("v", [[0] * 64, [1] * 64])["cluster"].alias("cluster"), "v")
    plan = wide.groupBy("cluster").count()._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEval" not in plan and plan.count("Exchange") <= 2
