"""Property tests against plain-Python recomputations on random inputs."""

import json
from collections import Counter

import numpy as np

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ratewise.functions import scalars as S
from ratewise.operators import clean, encode

SETTINGS = settings(max_examples=12, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

labels = st.lists(st.sampled_from([f"L{i}" for i in range(40)]), min_size=1, max_size=300)


@SETTINGS
@given(labels)
def test_frequency_index_matches_python(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "k string").repartition(5)
    d = encode.frequency_index(df, "k", "k_idx")
    got = {r.k: r.k_idx for r in d.table.collect()}
    c = Counter(xs)
    want = {k: i for i, k in enumerate(sorted(c, key=lambda k: (-c[k], k)))}
    assert got == want and d.size == len(c)


rows = st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]), st.sampled_from(["p1", "p2"]),
                          st.sampled_from([1.0, 2.0, 3.5, 5.0]),
                          st.one_of(st.none(), st.integers(0, 3))),
                min_size=1, max_size=40)


@SETTINGS
@given(rows)
def test_dedup_matches_python(spark, rs):
    df = spark.createDataFrame(rs, "UserId string, ProductId string, Score float, Time long")
    got = {(r.UserId, r.ProductId): r.Score for r in clean.dedup_latest(df).collect()}
    best = {}
    for u, p, s, t in rs:
        key = (-1 if t is None else t, s)   # null time ranks lowest
        if (u, p) not in best or key > best[(u, p)]:
            best[(u, p)] = key
    assert got == {k: v[1] for k, v in best.items()}


element = st.one_of(
    st.fixed_dictionaries({"product_idx": st.integers(0, 999), "rating": st.floats(-5, 10, width=32)}),
    st.fixed_dictionaries({"0": st.integers(0, 999), "1": st.floats(-5, 10, width=32)}),
    st.lists(st.floats(0, 999, width=32).map(lambda v: float(int(v))), min_size=2, max_size=3),
    st.lists(st.integers(0, 9), max_size=1),
    st.text(max_size=3),
    st.integers(),
)


def _python_normalise(elems):
    out = []
    for e in elems:
        if isinstance(e, dict):
            idx = e.get("product_idx", e.get("0"))
            score = e.get("rating", e.get("1", 0))
            out.append((idx, float(score)))
        elif isinstance(e, list) and len(e) >= 2:
            out.append((int(e[0]), float(e[1])))
    return out


@SETTINGS
@given(st.lists(element, max_size=6))
def test_normalise_matches_python(spark, elems):
    line = json.dumps({"user_idx": 1, "recommendations": elems})
    df = spark.createDataFrame([(line,)], "value string")
    parsed = df.select(S.parse_json("value", "user_idx int, recommendations array<string>").alias("j"))
    got = parsed.select(S.normalise_recommendations("j.recommendations").alias("r")).first().r
    want = _python_normalise(elems)
    assert [(e.product_idx, e.rating) for e in got] == \
        [(i, float(np.float32(s))) for i, s in want]
