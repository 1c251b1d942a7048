import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from ratewise.llm import simhash


def fingerprint(text):
    w = [x for x in (text or "").encode().lower().split() if x]
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def reach(values, max_bits):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for a, b in combinations(values, 2):
        if (a ^ b).bit_count() <= max_bits:
            parent[find(a)] = find(b)
    return {v: find(v) for v in values}


def brute(rows, max_bits=4):
    prints = [(i, fingerprint(t)) for i, t in rows]
    root = reach(sorted({f for _, f in prints}), max_bits)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, f"{f:016x}", least.get(root[f])) for i, f in prints),
                  key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("crowded", [0, 256])
def test_groups_equal_brute_force(odd_docs, rows_of, crowded):
    got = rows_of(simhash.near_groups(odd_docs, crowded=crowded), "doc_id", "fingerprint", "component_id")
    assert got == brute([(r.doc_id, r.text) for r in odd_docs.collect()])


@pytest.mark.parametrize("crowded", [1, 1000])
def test_chains_and_crowds(spark, crowded):
    """Random values, chains 4 bits apart, pairs 5 bits apart, dense balls."""
    rnd = random.Random(7)
    values = {rnd.getrandbits(64) for _ in range(60)}
    for _ in range(8):
        v = rnd.getrandbits(64)
        for step in range(12):
            v ^= sum(1 << b for b in rnd.sample(range(64), 4 if step % 5 else 5))
            values.add(v)
    centre = rnd.getrandbits(64)
    values |= {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for _ in range(150)}
    signed = [(v - (1 << 64) if v >> 63 else v, i) for i, v in enumerate(sorted(values))]
    nodes = spark.createDataFrame(signed, "fp long, doc long")
    edges = simhash.links(nodes.select("fp"), 4, crowded)
    for r in edges.collect():
        assert ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 4
    got = {r.fp & (2**64 - 1): r.label for r in simhash.components(nodes, edges).collect()}
    root, number = reach(sorted(values), 4), {v: i for i, v in enumerate(sorted(values))}
    least = {}
    for v in sorted(values):
        least.setdefault(root[v], number[v])
    assert {v: got.get(v, number[v]) for v in values} == {v: least[root[v]] for v in values}


def test_native_hash_is_the_same(spark):
    text = "Año nuevo rain plain"
    native = spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first().h & (2**64 - 1)
    assert native == xxhash.xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize("n", [0, 1, 5000, 10**6, 10**9, 10**12])
def test_every_plan_is_exact(n):
    """Any mask of up to 4 bits leaves at least one key untouched."""
    plan = simhash.block_plan(n)
    masks = [sum(((1 << w) - 1) << s for s, w in parts) for parts in plan]
    rnd = random.Random(n)
    for _ in range(500):
        bits = sum(1 << b for b in rnd.sample(range(64), 4))
        assert any(bits & m == 0 for m in masks)


def test_empty_table(no_docs):
    assert simhash.near_groups(no_docs).count() == 0


def test_odd_distances_are_refused_whatever_the_data(spark):
    prints = spark.createDataFrame([(1,)], "fp long")
    with pytest.raises(ValueError, match="even"):
        simhash.links(prints, max_bits=3)
