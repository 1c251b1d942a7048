"""Training corpus: documents -> quality -> exact dedup -> near dedup ->
decontamination -> packed sequences.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.

Defined results: rows with null or empty text pass quality and
decontamination, and one of them stays in dedup; repeated rows (same doc_id
and text) are one document and one row stays; an empty table packs to an
empty table; extra columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ratewise.llm import decontaminate, exact_dedup, packing, quality, simhash
from ratewise.llm.common import cut, fresh, scratch_path, table
from ratewise.llm.queries import BPE


def _only(docs: DataFrame, chosen: DataFrame, key: str, value) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, ``value``) is in ``chosen``
    (doc_id, key); of rows that are equal in both, one with the most code points.

    Rows equal in both are thinned first, partly before the shuffle, so a row
    repeated without end never meets in one task; what is left of the texts is
    shuffled once, by the key that the join needs too."""
    content, name, none, turn = fresh(docs, "_content", "_name", "_none", "_turn")
    own = {name: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), none: F.col("doc_id").isNull()}
    first = Window.partitionBy(name, none, content).orderBy(F.length(F.coalesce("text", F.lit(""))).desc(), "text")
    thinned = (docs.withColumns({**own, content: F.coalesce(value, F.lit(""))})  # plainly not null: no filter hashes it again
               .withColumn(turn, F.row_number().over(first)).where(F.col(turn) == 1))
    # an inner join: a semi join would be moved below the window again
    picked = chosen.select(*(c.alias(n) for n, c in own.items()), F.coalesce(key, F.lit("")).alias(content)).distinct()
    return thinned.join(picked, [name, none, content]).select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted_documents(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (without white space) the longest stays."""
    kept = exact_dedup.exact_groups(docs).where("kept").select("doc_id", "text_sha256")
    return _only(docs, cut(kept, "kept"), "text_sha256", F.sha2(exact_dedup.normalised(F.col("text")), 256))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest doc_id,
    a null one only if there is no other.  Rows are told apart by doc_id and
    text, so rows without an id or with the same one aren't taken together."""
    content = F.sha2(F.coalesce("text", F.lit("")), 256)
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", content.alias("content"))
    groups = simhash.near_groups(docs.select(row.alias("doc_id"), "text"))
    chosen = groups.select("component_id").distinct().select("component_id.doc_id", "component_id.content")
    return _only(docs, cut(chosen, "kept"), "content", content)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.packed_documents(docs, BPE)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# quality, fingerprints and token ids can't be expressed in SQL; the tests
# hold every stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
