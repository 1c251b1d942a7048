"""Helpers shared by the training-data operators: scratch tables, global
ranks, joins that stay balanced on hot keys, and slicing of Arrow batches."""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ratewise.session import checkpoint_dir

_POSITION_MASK = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | position
_made: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``; removed at exit."""
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@atexit.register
def _remove_scratch() -> None:
    for spark, path in _made:
        try:
            jvm, sc = spark._jvm, spark.sparkContext
            if sc._jsc is not None:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session may be gone; the folder is only scratch
            return


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` once as Parquet in the shared scratch folder and read it
    back: later steps neither recompute it nor depend on its row layout."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def posix_uri(path: str) -> str:
    """``file:/x`` as Hadoop prints it -> ``file:///x``; plain paths get a scheme."""
    if path.startswith("/"):
        return f"file://{path}"
    return re.sub(r"^file:/+", "file:///", path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with ``names`` that ``df`` does not have."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def global_rank(df: DataFrame, order: list[str], rank: str, ties: bool = False) -> DataFrame:
    """``df`` plus its 0-based position in the global order by ``order``.

    Range-partitioned sort, positions within each partition, and a prefix sum
    over one count per partition give each partition's base.  ``df`` should
    be cheap to read twice (the range bounds are sampled from it).  ``ties``:
    rows may be equal in ``order``, as many as there are; their place in ``df``,
    then a cut table, is the last key, so they don't fall into one partition.
    """
    pid, mid, base, n, place = fresh(df, "_pid", "_mid", "_base", "_n", "_place")
    if ties:
        df, order = df.withColumn(place, F.monotonically_increasing_id()), [*order, place]
    tagged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).drop(place)
                   .withColumns({pid: F.spark_partition_id(), mid: F.monotonically_increasing_id()}), "rank")
    before = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition
    bases = (tagged.groupBy(pid).agg(F.count(F.lit(1)).alias(n))
                   .select(pid, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base)))
    position = F.col(mid).bitwiseAND(F.lit(_POSITION_MASK))
    return (tagged.join(F.broadcast(bases), pid)
                  .withColumn(rank, (F.col(base) + position).cast("long")).drop(pid, mid, base))


def spread(df: DataFrame, rows: int, n_bytes: int, *order: str, task_bytes: int = 32 << 20) -> DataFrame:
    """Few small rows that each stand for much work (files, blocks), dealt to
    as many tasks as ``n_bytes`` of work need, at least one a core while there
    are rows.  An explicit range partitioning: the rows are too small for
    adaptive execution to see the work, and hashes would put several into one
    task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartitionByRange(max(1, min(rows, max(cores, -(-n_bytes // task_bytes)))), *order)


def join_spread(rows: DataFrame, keyed: DataFrame, on: list[str], n: str) -> DataFrame:
    """Inner join of ``rows`` (a cut table) with ``keyed`` (a cut table, one
    row per key, ``n`` = the key's rows).

    A key with more rows than half a mean shuffle partition is hot.  There
    are at most twice as many hot keys as partitions, so these few are
    broadcast and their rows stay where they are; the others are shuffled.
    """
    limit = max(1000, rows.count() // (2 * width(rows.sparkSession)))
    hot = F.broadcast(keyed.where(F.col(n) > limit))
    cold = keyed.where(F.col(n) <= limit)
    near = rows.join(hot, on)
    far = rows.join(hot.select(*on), on, "left_anti").join(cold, on)
    return near.unionByName(far)


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges of ``batch`` holding about ``size`` bytes of ``column``."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    start, room = 0, size
    for i, n in enumerate(lengths.tolist()):
        if room < n and i > start:
            yield start, i
            start, room = i, size
        room -= n
    if start < len(lengths):
        yield start, len(lengths)


def crc_mod(column: Column, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus`` (null stays null)."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(modulus))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_schema(schema: T.StructType) -> pa.Schema:
    """Arrow schema of a flat Spark schema (long, int, double, boolean, string, binary)."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
             "string": pa.string(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64()),
             "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields])
