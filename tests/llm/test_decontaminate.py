import hashlib
import re

import pytest

from ratewise.llm import decontaminate as D

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for s in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[s:s + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for win, ids in windows.items():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s:s + len(win)]) == win:
                    hit.update(range(s, s + len(win)))
                    found |= ids - {None}
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
ITEMS = [(1, "Rain in SPAIN"), (2, "rain-in, spain!"), (10, "größe façade"), (3, " ".join(f"w{i}" for i in range(14))),
         (4, None), (5, "!!!"), (6, "again and again and again and again and again and again"), (7, "x86 the of and"), (3, "one two"),
         (None, "42 x86"), (None, "Rain in Spain"), (None, None)]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, i) for i, t in ITEMS], "item_id long, text string, n_words int")


@pytest.fixture(scope="module")
def docs(spark, odd_docs):
    more = [(500, "see " + " ".join(f"W{i}," for i in range(2, 13)) + " end"), (501, " ".join(f"w{i}" for i in range(9)))]
    return odd_docs.where("doc_id not in (12, 13, 14) or doc_id is null").select("doc_id", "text").unionByName(
        spark.createDataFrame(more, "doc_id long, text string"))


@pytest.mark.parametrize("block_words", [5, 10_000])
def test_equals_brute_force(docs, items, rows_of, block_words):
    got = rows_of(D.contamination(docs, items, block_words=block_words), *COLUMNS)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], ITEMS)


def test_a_long_item_is_cut_into_overlapping_parts(spark, rows_of):
    rows = [(1, " ".join(f"v{i}" for i in range(100))), (2, "!"), (3, "v95 v96"), (1, "v1 v2")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    docs = [(s, " ".join(f"V{i}" for i in range(s, s + n))) for s in range(0, 100, 7) for n in (9, 10, 30)] + [(200, rows[0][1])]
    blocks = list(D.item_blocks(items, block_words=25))
    assert len(blocks) > 3 and max(sum(len(D.words_of(t)) for _, t in b) for b in blocks) <= 25
    got = D.contamination(spark.createDataFrame(docs, "doc_id long, text string"), items, block_words=25)
    assert rows_of(got, *COLUMNS) == brute(docs, rows)


def test_blocks_have_a_letter_for_every_word(spark, monkeypatch):
    """More distinct words than characters, in one item and in two."""
    texts = [" ".join(f"{i:x}" for i in range(a, b)) for a, b in ((0, 1_200_000), (1_200_000, 1_900_000))]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    monkeypatch.setattr(D, "BLOCK_BYTES", 1 << 30)
    found, first = set(), True
    for block in D.item_blocks(items, block_words=2_000_000):
        words = [w for _, t in block for w in D.words_of(t)]
        assert len(set(words)) <= 0x10FFFF - 0x800
        if first:  # the letters themselves, without the automaton
            scanner, first = D.Scanner([], 10), False
            letters = set(map(scanner._code, words))
            assert len(letters) == len(set(words)) and D._OTHER not in letters
        found.update(words)
    assert len(found) == 1_900_000


def test_a_large_benchmark_in_several_blocks(spark, rows_of):
    """450 000 words, null ids among them, against a set of all windows."""
    import random
    rnd = random.Random(12)
    rows = [(None if k % 9 == 0 else k, " ".join(f"w{rnd.randrange(60_000)}" for _ in range(9000))) for k in range(50)]
    items = spark.createDataFrame(rows, "item_id long, text string")
    assert len(list(D.item_blocks(items))) == 3
    windows = {}
    for item, text in rows:
        w = text.split()
        for s in range(len(w) - 9):
            windows.setdefault(tuple(w[s:s + 10]), set()).add(item)
    docs = []
    for k in range(120):
        w = [f"w{rnd.randrange(60_000)}" for _ in range(rnd.randint(0, 80))]
        for _ in range(k % 4):
            text, at = rows[rnd.randrange(50)][1].split(), rnd.randrange(8000)
            w += text[at:at + rnd.randint(7, 25)]
        docs.append((k, " ".join(w)))
    want = []
    for k, text in docs:
        w, hit, found = text.split(), set(), set()
        for s in range(len(w) - 9):
            ids = windows.get(tuple(w[s:s + 10]))
            if ids is not None:
                hit.update(range(s, s + 10))
                found |= ids - {None}
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        want.append((k, len(w), len(hit), len(found), digest, bool(hit)))
    got = rows_of(D.contamination(spark.createDataFrame(docs, "doc_id long, text string"), items), *COLUMNS)
    assert got == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert any(r[2] and not r[3] for r in want)  # hit by an item without an id alone


def test_offsets_are_in_the_original_text(spark, items):
    text = "Ünder, GRÖSSE — größe\n FAÇADE größe façade; and Rain, in Spain."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = sorted((r.start, r.end, r.passage) for r in D.hit_spans(docs, items).collect())
    assert [p for _, _, p in got] == ["größe façade", "Rain, in Spain"]
    assert all(text[a:b] == p for a, b, p in got)


def test_items_without_id_are_removed_too(spark):
    items = spark.createDataFrame([(None, "largo al factotum"), (1, "rain in Spain"), (None, "Rain in Spain")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Largo al factotum!"), (2, "the rain in Spain"), (3, "al factotum largo"), (4, None)], "doc_id long, text string")
    for block_words in (3, 10_000):
        assert sorted(r.doc_id for r in D.clean_documents(docs, items, block_words=block_words).collect()) == [3, 4]


def test_clean_documents_keep_all_columns(odd_docs, items, no_docs, spark):
    clean = D.clean_documents(odd_docs, items, block_words=5)
    assert clean.schema == odd_docs.schema
    dirty = D.contamination(odd_docs, items).where("contaminated").count()
    assert 0 < dirty and clean.count() == odd_docs.count() - dirty
    assert D.contamination(no_docs, items).count() == 0
    none = D.contamination(odd_docs, items.limit(0))
    assert none.count() == odd_docs.count() and none.where("contaminated").count() == 0
