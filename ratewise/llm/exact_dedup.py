"""Exact dedup by deterministic block naming (DataFrame operations only).

A text without its white space is cut into fixed-size blocks.  The distinct
blocks of the whole corpus are sorted and get integer names; then adjacent
names of a document are paired, the distinct pairs sorted and named, and so
on until one name is left.  Texts with as many blocks and the same last name
are equal, and no others: a name stands for one content, never for a hash.

Block bytes cross the network once, in the aggregate that finds the distinct
blocks (partly done before the shuffle, so a block held by a third of all
documents arrives once per map task).  Names are ordered by (hash, block).
The hash only routes: rows fetch the name by hash where one block has that
hash, and by block content where several do.

Defined results: null counts as empty; an empty text has one empty block;
equal texts are one group; repeated rows (same doc_id and text) count as
rows of the group, and all or none of them are marked kept; a null doc_id
sorts after all others as the row that stays; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import cut, global_rank, join_spread

BLOCK_BYTES = 8192
WHITE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")  # fixed values: [\x20\x09-\x0D]


def normalised(text: Column) -> Column:
    """The text without white space (null: empty)."""
    out = F.coalesce(text, F.lit(""))
    for c in WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _route(value: Column) -> Column:
    return F.xxhash64(value)


def _documents(docs: DataFrame, block_bytes: int) -> DataFrame:
    """One row per document row: key, sizes and the normalised bytes."""
    norm = normalised(F.col("text"))
    return (docs.select(F.col("doc_id"), F.col("text"), norm.alias("norm"))
                .select("doc_id", F.sha2("norm", 256).alias("sha"),
                        F.length(F.coalesce("text", F.lit(""))).alias("chars"),
                        F.col("norm").cast("binary").alias("norm"))
                .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.octet_length("norm") / block_bytes)).cast("int")))


def _blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """One row per block; ``substring`` of binary takes bytes, not a scan."""
    at = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("pos")
    return (rows.select("doc_id", "sha", "chars", "blocks", "norm", at)
                .select("doc_id", "sha", "chars", "blocks", "pos",
                        F.substring("norm", F.col("pos") * block_bytes + 1, F.lit(block_bytes)).alias("block")))


def _named_blocks(blocks: DataFrame, route: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, sha, chars, blocks, pos, name): each block's integer name."""
    keyed = blocks.withColumn("h", route(F.col("block")))
    # the only shuffle that carries text; one row per distinct block
    distinct = keyed.groupBy("h", "block").agg(F.count(F.lit(1)).alias("n"))
    slim = cut(distinct.select("h", "n"), "blocks")
    by_hash = slim.groupBy("h").agg(F.count(F.lit(1)).alias("variants"), F.sum("n").alias("n"))
    by_hash = cut(by_hash, "hashes")
    single = by_hash.where("variants = 1")
    named = global_rank(single.select("h", "n"), ["h"], "name")
    rows = cut(keyed.drop("block"), "rows")
    shared = cut(by_hash.where("variants > 1").select("h"), "shared")
    out = join_spread(rows, named, ["h"], "n").drop("h", "n")
    if shared.isEmpty():
        return out
    # different blocks with the same hash: order and fetch by content
    some = keyed.join(shared, "h", "left_semi")
    first = named.count()
    again = global_rank(cut(some.groupBy("h", "block").agg(F.count(F.lit(1)).alias("n")), "variants"),
                        ["h", "block"], "name")
    found = join_spread(cut(some, "rows"), again, ["h", "block"], "n")
    return out.unionByName(found.withColumn("name", F.col("name") + first).drop("h", "block", "n"))


def _paired(names: DataFrame) -> DataFrame:
    """One naming round: (doc_id, sha, blocks, pos, name) with half the positions."""
    half = F.floor(F.col("pos") / 2).cast("int")
    pairs = cut(names.groupBy("doc_id", "sha", "blocks", half.alias("pos")).agg(
        F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
        F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right")), "pairs")
    distinct = cut(pairs.groupBy("left", "right").agg(F.count(F.lit(1)).alias("n")), "distinct")
    named = global_rank(distinct, ["left", "right"], "name")
    return cut(join_spread(pairs, named, ["left", "right"], "n").drop("left", "right", "n"), "round")


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES,
               route: Callable[[Column], Column] = _route) -> DataFrame:
    """Per document row: doc_id, sha, chars, blocks, name.  (blocks, name) is
    the document's identity.  ``docs`` needs doc_id and text."""
    rows = _documents(docs.select("doc_id", "text"), block_bytes)
    named = cut(_named_blocks(_blocks(rows, block_bytes), route), "named")
    whole = named.where("blocks = 1").select("doc_id", "sha", "chars", "blocks", "name")
    longest = named.agg(F.max("blocks")).first()[0] or 1
    if longest == 1:
        return whole
    level = named.where("blocks > 1").select("doc_id", "sha", "blocks", "pos", "name")
    done, reach = None, 1
    while reach < longest:
        level, reach = _paired(level), reach * 2
        ended = level.where(F.col("blocks") <= reach).select("doc_id", "sha", "blocks", "name")
        done = ended if done is None else done.unionByName(ended)
        level = level.where(F.col("blocks") > reach)
    # every document row of several blocks has one row at pos 0
    several = named.where("blocks > 1 and pos = 0").select("doc_id", "sha", "chars", "blocks")
    key = several["doc_id"].eqNullSafe(done["doc_id"]) & (several["sha"] == done["sha"])
    return whole.unionByName(several.join(done, key).select(
        several["doc_id"], several["sha"], "chars", several["blocks"], "name"))


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES,
                 route: Callable[[Column], Column] = _route) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document row.

    Of equal texts the row with the most code points stays, then the smallest
    doc_id."""
    ids = cut(identities(docs, block_bytes, route), "identities")
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("none"),
                          F.col("doc_id").alias("doc_id")))
    groups = cut(ids.groupBy("blocks", "name").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")), "groups")
    out = join_spread(ids, groups, ["blocks", "name"], "group_size")
    kept = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("chars") == -F.col("best.less"))
    return out.select("doc_id", F.col("best.doc_id").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"),
                      kept.alias("kept"), F.col("sha").alias("text_sha256"))
