"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints (64 bits over the XXH64 of 4-word shingles) are linked when at
most 4 bits differ.  The 64 bits are cut into ``blocks`` parts; two linked
fingerprints differ in at most 4 parts, so they agree on some
``blocks - 4`` of them: each choice of so many parts is one key, rows that
share a key are candidates, and the bits decide.  More parts give longer
keys; the number of parts follows the number of distinct fingerprints
(any choice finds the same links).

Each fingerprint is first linked to a few near members of its keys; only keys
whose members these links leave in different components are joined with
themselves, the members outside the largest component with all.  Where there
are very many such members, they aren't joined either: the key's fingerprints
are linked through their balls.  Two values at distance 4 or less have a
common value within 2 bits of both, so every such fingerprint points at the
2081 values around it, and fingerprints that meet in a value are linked to the
smallest one there.  That is linear in the group and finds the same
components.

Components come from min-label rounds over links between distinct
fingerprints, cut to scratch each round; equal fingerprints are grouped
before, so copies cost no links.

Defined results: null or blank text has fingerprint zero, linked like any
other; repeated rows keep one row each; component_id ignores null doc_ids
(null where a component has no other); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import cut, join_spread, slices

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
CROWDED = 256  # members of one key outside its largest component, beyond which balls are used
SLICE_BYTES = 1 << 20


def fingerprint_values(texts: list[bytes], words: int = SHINGLE_WORDS) -> np.ndarray:
    """The 64-bit fingerprints (as int64) of lower-cased UTF-8 texts."""
    import xxhash
    digest = xxhash.xxh64_digest
    out = np.zeros(len(texts), dtype=np.uint64)
    weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
    for i, text in enumerate(texts):
        w = text.lower().split()  # ASCII letters and ASCII white space only, on bytes
        if not w:
            continue
        total, n = np.zeros(64, dtype=np.int64), max(1, len(w) - words + 1)
        for start in range(0, n, 65536):
            part = w[start:start + 65536 + words - 1]
            grams = map(b" ".join, zip(*(part[k:] for k in range(words)))) if len(w) >= words else [b" ".join(w)]
            bits = np.frombuffer(b"".join(digest(g, HASH_SEED) for g in grams), dtype=np.uint8)
            total += np.unpackbits(bits.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out[i] = weights[total * 2 > n].sum(dtype=np.uint64)
    return out.view(np.int64)


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp long) per document row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch, "text", SLICE_BYTES):
                part = batch.slice(a, b - a)
                texts = [t or b"" for t in part.column("text").to_pylist()]
                yield pa.record_batch([part.column("doc_id"), pa.array(fingerprint_values(texts, words))],
                                      names=["doc_id", "fp"])
    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint")


def block_plan(n: int, max_bits: int = MAX_BITS) -> list[list[tuple[int, int]]]:
    """Keys as lists of (shift, width): every choice of ``blocks - max_bits``
    of the parts.  The least number of parts whose keys spread ``n``
    fingerprints over at least twice as many values as there are fingerprints."""
    blocks = max_bits + 1
    while blocks < max_bits + 4 and (64 // blocks) * (blocks - max_bits) < max(n, 1).bit_length() + 2:
        blocks += 1
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [(edges[k], edges[k + 1] - edges[k]) for k in range(blocks)]
    return [list(c) for c in combinations(parts, blocks - max_bits)]


def _keys(prints: DataFrame, plan: list[list[tuple[int, int]]]) -> DataFrame:
    """(fp, slot, key) for every key of the plan."""
    made = []
    for slot, parts in enumerate(plan):
        key = F.lit(0).cast("long")
        for shift, bits in parts:
            part = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << bits) - 1))
            key = F.shiftleft(key, bits).bitwiseOR(part)
        made.append(F.struct(F.lit(slot).alias("slot"), key.alias("key")))
    return prints.select("fp", F.explode(F.array(*made)).alias("k")).select("fp", "k.slot", "k.key")


def _ball_masks(radius: int) -> np.ndarray:
    """All 64-bit masks with at most ``radius`` bits."""
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(64), r)]
    return np.array(masks, dtype=np.uint64).view(np.int64)


def _ball_links(crowd: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) that connect all fingerprints of ``crowd`` within
    ``max_bits``: through common points half that far from both."""
    masks = _ball_masks((max_bits + 1) // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False)
            for a in range(0, len(values), 256):
                v = values[a:a + 256]
                yield pa.record_batch([pa.array(np.repeat(v, len(masks))),
                                       pa.array((v[:, None] ^ masks[None, :]).ravel())], names=["fp", "point"])
    points = crowd.mapInArrow(run, "fp bigint, point bigint")
    # min, max and the count are reduced before the shuffle; a point that
    # joins more than two values is opened again below
    meet = points.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("z"))
    meet = cut(meet.where("a < z").select("point", "a"), "meet")
    members = points.join(meet, "point").where("fp > a")
    return members.select("a", F.col("fp").alias("b")).distinct()


def links(prints: DataFrame, max_bits: int = MAX_BITS, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``prints`` (fp) whose
    components are those of all pairs within ``max_bits``.

    First every fingerprint is linked to near anchors of its keys: for each of
    four kinds of anchor (smallest, largest, and so by hash) one link at most.
    What these links connect needs no more of them, so pairs are only sought in
    keys whose members are still in different components, and only between
    those."""
    if max_bits % 2:  # whatever the data: a crowded key needs common points half that far from both
        raise ValueError("max_bits must be even")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    keyed = cut(_keys(prints, block_plan(prints.count(), max_bits)), "keys")
    other = F.struct(F.xxhash64("fp").alias("h"), F.col("fp").alias("fp"))
    anchors = F.array(F.min("fp"), F.max("fp"), F.min(other)["fp"], F.max(other)["fp"])
    shared = cut(keyed.groupBy("slot", "key").agg(F.count(F.lit(1)).alias("n"), anchors.alias("anchors"))
                 .where("n > 1").drop("n"), "shared")
    members = cut(keyed.join(shared.hint("merge"), ["slot", "key"]).withColumnRenamed("fp", "b"), "members")
    found = F.transform("anchors", lambda a, i: F.struct(i.alias("which"), a.alias("a")))
    found = F.filter(found, lambda x: (x["a"] != F.col("b")) & (F.bit_count(x["a"].bitwiseXOR(F.col("b"))) <= max_bits))
    star = (members.select("b", F.explode(found).alias("x")).groupBy("b", "x.which").agg(F.min("x.a").alias("a")))
    star = cut(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "star")
    group = spread_labels(star).select(F.col("fp").alias("b"), "label")
    placed = cut(members.join(group, "b", "left").select("slot", "key", "b", F.coalesce("label", "b").alias("group")), "placed")
    sizes = placed.groupBy("slot", "key", "group").agg(F.count(F.lit(1)).alias("n"))
    mixed = cut(sizes.groupBy("slot", "key").agg(F.max(F.struct("n", "group")).alias("top"), F.sum("n").alias("n"),
                                                 F.count(F.lit(1)).alias("groups")).where("groups > 1")
                .select("slot", "key", F.col("top.group").alias("main"), (F.col("n") - F.col("top.n")).alias("others")), "mixed")
    still = cut(placed.join(mixed.hint("merge"), ["slot", "key"]), "still")
    # of two members in different components one isn't in the key's largest
    few = still.where(F.col("others") <= crowded)
    left = few.where(F.col("group") != F.col("main")).select("slot", "key", F.col("b").alias("a"), F.col("group").alias("own"))
    pairs = (left.join(few.select("slot", "key", "b", "group").hint("merge"), ["slot", "key"])
             .where((F.col("own") != F.col("group")) & near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    found = star.unionByName(pairs.distinct())
    inside = cut(still.where(F.col("others") > crowded).select(F.col("b").alias("fp")).distinct(), "crowd")
    if not inside.isEmpty():
        found = found.unionByName(_ball_links(inside, max_bits))
    return cut(found, "links")


def spread_labels(edges: DataFrame) -> DataFrame:
    """(fp, label): the smallest node reachable from each linked node.

    ``edges``: (a, b), a cut table.  Each round takes the least label among the
    neighbours' and then the label of the label's own node, until no label
    changes."""
    both = cut(edges.select(F.col("a").alias("fp"), F.col("b").alias("to"))
               .unionByName(edges.select(F.col("b").alias("fp"), F.col("a").alias("to"))).distinct(), "edges")
    label = cut(both.groupBy("fp").agg(F.min("to").alias("m")).select("fp", F.least("fp", "m").alias("label")), "label")
    while True:
        seen = both.join(label.withColumnRenamed("fp", "to"), "to").groupBy("fp").agg(F.min("label").alias("m"))
        step = cut(label.join(seen, "fp").select("fp", "label", F.least("label", "m").alias("m")), "step")
        jump = step.select(F.col("fp").alias("m"), F.col("m").alias("further"))
        after = cut(step.join(jump, "m").select("fp", "label", F.least("m", "further").alias("m")), "label")
        changed = not after.where("m < label").isEmpty()
        label = after.select("fp", F.col("m").alias("label"))
        if not changed:
            return label


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, label): the smallest ``doc`` reachable from each linked node of
    ``nodes`` (fp, doc), a cut table."""
    label = spread_labels(edges)
    docs = label.join(nodes, "fp").groupBy("label").agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("n"))
    return join_spread(label, cut(docs, "docs"), ["label"], "n").select("fp", F.col("doc").alias("label"))


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                crowded: int = CROWDED) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per document row."""
    prints = cut(fingerprints(docs, words), "prints")
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("n")), "nodes")
    found = links(nodes.select("fp"), max_bits, crowded)
    joined = components(nodes.select("fp", "doc"), found)
    known = cut(nodes.join(joined, "fp", "left").select("fp", "n", F.coalesce("label", "doc").alias("component_id")),
                "components")
    return join_spread(prints, known, ["fp"], "n").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
