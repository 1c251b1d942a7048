"""Scalar column expressions (F-1 .. F-15), all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise import config


def parse_json(text: Column | str, schema: T.StructType | str) -> Column:
    """F-1: JSON text -> struct with a fixed schema.  Malformed text gives a
    struct of nulls, a null input a null struct, a bad field a null field."""
    return F.from_json(F.col(text) if isinstance(text, str) else text, schema)


def to_json_text(*cols: Column | str) -> Column:
    """F-2: struct of the columns -> JSON text."""
    return F.to_json(F.struct(*cols))


def as_text(binary: Column | str) -> Column:
    """F-3: bytes -> string."""
    return (F.col(binary) if isinstance(binary, str) else binary).cast("string")


def safe_cast(c: Column | str, dtype: T.DataType | str) -> Column:
    """F-4: cast that yields null instead of failing the job."""
    return (F.col(c) if isinstance(c, str) else c).try_cast(dtype)


def round4(c: Column | str) -> Column:
    """F-5: round to 4 decimals (as double)."""
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 4)


def product_label(idx: Column | str) -> Column:
    """F-6: ``Product_<idx>``; ``Product_?`` when the index is missing."""
    c = F.col(idx) if isinstance(idx, str) else idx
    return F.concat(F.lit(config.PRODUCT_LABEL_PREFIX), F.coalesce(c.cast("string"), F.lit("?")))


def clamp(c: Column, lo: int, hi: int) -> Column:
    """F-8: ``min(max(c, lo), hi)``."""
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def with_default(c: Column, default) -> Column:
    """F-9: value, or the default when absent."""
    return F.coalesce(c, F.lit(default))


def run_status(n_files: Column) -> Column:
    """F-10: warning when no file was produced, success otherwise."""
    return F.when(n_files == 0, F.lit(config.STATUS_WARN)).otherwise(F.lit(config.STATUS_OK))


def non_blank(line: Column | str) -> Column:
    """F-11: predicate for a line with something besides whitespace."""
    c = F.col(line) if isinstance(line, str) else line
    return F.trim(c) != ""


def iso_now() -> Column:
    """F-12: run timestamp as ISO-8601 text."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def variant_field(v: Column, path: str, kind: str) -> Column:
    """A field of a parsed VARIANT as ``kind``; null where it is missing or of
    another kind."""
    return F.try_variant_get(v, path, kind)


def normalise_recommendations(raw_list: Column) -> Column:
    """F-13 for ``array<string>`` of raw JSON elements."""
    return normalise_elements(F.transform(raw_list, F.try_parse_json))


def normalise_elements(elements: Column) -> Column:
    """F-13: ``array<variant>`` of list elements -> ``array<struct<
    product_idx int, rating float>>``.

    Accepted elements: ``{"product_idx": i, "rating": s}``,
    ``{"0": i, "1": s}`` and ``[i, s, ...]``.  Dicts missing both index keys
    keep a null index (shown as ``Product_?``); a missing score is 0;
    elements of any other shape are dropped.
    """
    def one(e: Column) -> Column:
        kind = F.schema_of_variant(e)
        as_dict = F.struct(
            F.coalesce(variant_field(e, "$.product_idx", "int"), variant_field(e, '$["0"]', "int")).alias("product_idx"),
            F.coalesce(variant_field(e, "$.rating", "float"), variant_field(e, '$["1"]', "float"),
                       F.lit(0.0).cast("float")).alias("rating"))
        as_list = F.struct(variant_field(e, "$[0]", "int").alias("product_idx"),
                           variant_field(e, "$[1]", "float").alias("rating"))
        pair = F.size(variant_field(e, "$", "array<variant>")) >= 2
        return F.when(kind.startswith("OBJECT"), as_dict).when(kind.startswith("ARRAY") & pair, as_list)
    return F.filter(F.transform(elements, one), lambda x: x.isNotNull())


def item_labels(recs: Column) -> Column:
    """F-14: list -> array of ``Product_<idx>`` labels."""
    return F.transform(recs, lambda r: product_label(r["product_idx"]))


def item_details(recs: Column) -> Column:
    """F-14: list -> array of ``(product_id, product_idx, score)`` structs."""
    return F.transform(recs, lambda r: F.struct(
        product_label(r["product_idx"]).alias("product_id"),
        r["product_idx"].alias("product_idx"),
        round4(r["rating"]).alias("score")))


def dot(u: Column | str, v: Column | str) -> Column:
    """F-15: double-precision dot product of two float arrays."""
    u = F.col(u) if isinstance(u, str) else u
    v = F.col(v) if isinstance(v, str) else v
    return F.aggregate(F.zip_with(u, v, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)
