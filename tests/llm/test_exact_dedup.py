import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from ratewise.llm.exact_dedup import exact_groups, identities

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def brute(docs):
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i is None, i))
    out = []
    for i, t in rows:
        n = re.sub(r"[\x20\x09-\x0D]", "", t)
        best = min(groups[n], key=lambda x: (x[0], x[1], x[2] or 0))
        out.append((i, best[2], len(groups[n]), i == best[2] and len(t) == -best[0],
                    hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_groups_equal_brute_force(odd_docs, rows_of):
    assert rows_of(exact_groups(odd_docs, block_bytes=64), *COLUMNS) == brute(odd_docs)
    assert rows_of(exact_groups(odd_docs), *COLUMNS) == brute(odd_docs)


def test_no_collision_with_a_bad_hash(odd_docs, rows_of):
    """Names come from content: three hash values give the same groups."""
    bad = exact_groups(odd_docs, block_bytes=512, route=lambda v: F.pmod(F.xxhash64(v), F.lit(3)))
    assert rows_of(bad, *COLUMNS) == brute(odd_docs)


def test_names_are_deterministic(odd_docs, rows_of):
    a, b = (rows_of(identities(d, 128), "doc_id", "blocks", "name") for d in (odd_docs, odd_docs.repartition(3)))
    assert a == b


def test_empty_table(no_docs):
    assert exact_groups(no_docs).count() == 0


def test_hot_group(spark, rows_of):
    """A third of all rows are one text; they take the broadcast side."""
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("copy of a long text " * 40)).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    out = exact_groups(docs, block_bytes=100)
    assert out.where("group_size = 3000 and keep_id = 0").count() == 3000
    assert out.where("kept").count() == 6001
