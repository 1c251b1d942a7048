"""The registered queries of the training-data operators, and their SQL.

Each query applies its operator with production parameters to the whole
table and returns the operator's full result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ratewise.llm import (clusters, decontaminate, exact_dedup, language, lattice_lm, packing, quality, secrets, simhash,
                          token_counts, token_files, vector_codes, vector_sql, warc)
from ratewise.llm.common import table

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), BPE)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), BPE)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.lattice_lm(table(spark, sf_dir, "documents"), PIECES)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), BPE)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.centroid_clusters(table(spark, sf_dir, "embeddings"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_decontamination, op2_packing, op3_token_files, op4_language, op5_quality, op6_lattice_lm, op7_warc,
             op8_exact_dedup, op9_token_counts, op10_simhash, op11_secret_scan, op12_centroid_clusters,
             op13_vector_codes)
    return {f.__name__: f for f in every}


_WORDS = """regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

OP1_SQL = f"""
WITH item_words AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, w[s : s + 9] AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item_words WHERE len(w) > 0)),
windows AS (SELECT win, len(win) AS n, list(DISTINCT item_id) FILTER (WHERE item_id IS NOT NULL) AS ids FROM item_windows GROUP BY win),
lengths AS (SELECT DISTINCT n FROM windows),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
places AS (
    SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM docs, lengths WHERE len(w) >= n),
hits AS (SELECT p.r, p.s, p.n, t.ids FROM places p JOIN windows t ON t.win = p.w[p.s : p.s + p.n - 1]),
hit_words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS k FROM hits) GROUP BY r),
hit_items AS (
    SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
    FROM (SELECT DISTINCT r, CAST(unnest(ids) AS VARCHAR) AS i FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
    sha256(coalesce(i.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words h ON h.r = d.r LEFT JOIN hit_items i ON i.r = d.r
"""

OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
g AS (SELECT html, max(page_id) AS keep FROM p WHERE n >= 1000 GROUP BY html),
j AS (SELECT p.page_id, p.n, sha1(p.html) AS digest, CASE WHEN p.page_id <> g.keep THEN g.keep END AS refers_to
      FROM p LEFT JOIN g ON g.html = p.html)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
    CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM j
"""

OP8_SQL = """
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars,
        sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256,
        regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body
    FROM documents),
w AS (
    SELECT doc_id, chars, text_sha256,
        first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
        count(*) OVER (PARTITION BY body) AS group_size
    FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": OP1_SQL, "op7_warc": OP7_SQL, "op8_exact_dedup": OP8_SQL,
            "op12_centroid_clusters": vector_sql.clusters_sql(), "op13_vector_codes": vector_sql.codes_sql()}
