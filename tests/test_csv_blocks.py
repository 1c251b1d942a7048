"""Parallel multi-line CSV against Spark's own multi-line reader."""
import os
import random

import pytest
from pyspark.sql import functions as F

from ratewise.sources import csv_blocks
from ratewise.sources.reviews import read_review_csv

TEXTS = ["", "plain", "a, b", 'say ""hi""', "two\nlines", "\n\n", 'x\n""quoted"", and\nmore', "café 北京", '""', "," * 5,
         "long " * 40 + "\n" + "tail " * 30]


def _text(rnd):
    t = rnd.choice(TEXTS)
    return f'"{t}"' if any(c in t for c in ',\n"\r') or rnd.random() < 0.3 else t


@pytest.fixture()
def small_blocks(spark):
    """Blocks of 97 bytes: borders fall into quotes, doubled quotes and line ends."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 97)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _write(folder, name, rows, end="\n"):
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(end.join(rows))


def _reference(spark, path):
    return (spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_multiline_reader(spark, tmp, small_blocks, seed):
    rnd = random.Random(seed)
    for name in ("a.csv", "b.csv", "c.csv"):
        rows = ["Id,Title,Text"]
        for i in range(rnd.randint(0, 60)):
            rows.append(f"{name}{i},{_text(rnd)},{_text(rnd)}")
            if rnd.random() < 0.1:
                rows.append("")
        _write(tmp, name, rows, rnd.choice(["\n", "\n", "\r\n"]))
    assert _rows(csv_blocks.read_csv_blocks(spark, tmp)) == _rows(_reference(spark, tmp))


def test_one_file_in_many_blocks(spark, tmp, small_blocks):
    """A record over many blocks, a quoted header, blank lines at the start."""
    _write(tmp, "one.csv", ["", '"Id","Te""xt"', '1,"' + "line\n" * 200 + '"', "2,x", '3,"y\n"'])
    lines = csv_blocks._lines(spark, tmp)
    states = csv_blocks.entry_states(csv_blocks.quote_maps(lines)).orderBy("block").collect()
    assert len(states) > 8 and sum(r.inside for r in states) > 5
    assert lines.rdd.getNumPartitions() > 4
    got = csv_blocks.read_csv_blocks(spark, tmp)
    assert got.columns == ["Id", 'Te"xt']
    assert _rows(got) == _rows(_reference(spark, tmp))


def test_joined_states_equal_broadcast_ones(spark, tmp, small_blocks, monkeypatch):
    rnd = random.Random(9)
    _write(tmp, "a.csv", ["Id,Text"] + [f"{i},{_text(rnd)}" for i in range(80)])
    want = _rows(csv_blocks.read_csv_blocks(spark, tmp))
    monkeypatch.setattr(csv_blocks.config, "BROADCAST_MAX_ROWS", 0)
    assert _rows(csv_blocks.read_csv_blocks(spark, tmp)) == want == _rows(_reference(spark, tmp))


def test_scan_of_maps_equals_composition(spark):
    """Every sequence of identity, swap and constant maps, against a loop."""
    rnd = random.Random(2)
    rows, want = [], {}
    for f in range(30):
        state = False
        for b in range(25):
            m = rnd.choice([(False, True), (True, False), (False, False), (True, True)])
            rows.append((f"f{f}", b, *m))
            want[f"f{f}", b] = (state, m[state])
            state = m[state]
    maps = spark.createDataFrame(rows, "file string, block long, from_outside boolean, from_inside boolean")
    got = {(r.file, r.block): (r.inside, r.leaves) for r in csv_blocks.entry_states(maps).collect()}
    assert got == want


def test_states_of_lines():
    cases = {b"a,b": (False, None), b'"a,b': (True, None), b'"a""': (True, None), b'5" x,"y': (True, None),
             b'a"b"c': (False, None), b'","': (False, None), b'",""': (True, None), b"": (False, True),
             b'end",x': (False, False), b'end","x': (True, True), b'""': (False, True), b'"': (True, False)}
    for line, (outside, inside) in cases.items():
        assert csv_blocks.ends_inside(line, False) is outside, line
        if inside is not None:
            assert csv_blocks.ends_inside(line, True) is inside, line


def test_reviews_prune_to_used_columns(spark, tmp, small_blocks):
    _write(tmp, "r.csv", ["Id,ProductId,UserId,Score,Time,Text"] + [f'{i},P{i},U{i},{i % 5},{i},"t\n{i}"' for i in range(50)])
    df = read_review_csv(spark, tmp)
    assert df.count() == 50 and df.agg(F.sum("Time")).first()[0] == sum(range(50))


def test_header_only_and_crlf(spark, tmp):
    _write(tmp, "h.csv", ["Id,Text"], "\r\n")
    assert csv_blocks.read_csv_blocks(spark, tmp).count() == 0
    _write(tmp, "i.csv", ["Id,Text", '1,"a\r\nb"', "2,c", ""], "\r\n")  # line ends inside quotes are kept
    assert _rows(csv_blocks.read_csv_blocks(spark, tmp)) == [("1", "a\r\nb"), ("2", "c")]
