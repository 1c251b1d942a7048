"""Session construction and lineage cutting.

On a cluster the session is created by the launcher; ``checkpoint_dir``
only reads ``spark.checkpoint.dir`` from it.  A local directory is used
only when the master is local and nothing is configured (tests).
"""

from __future__ import annotations

import atexit
import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ratewise", extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and local benchmarking."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RATEWISE_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, as configured on the session.

    Falls back to a fresh temporary folder only in local mode.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS / object store) so lineage cuts survive executor loss")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ratewise-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where later steps depend on a physical row layout (partition ids)
    that must not change if a task is recomputed after an executor loss.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_scratch: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint location (never a local tmp
    on a cluster); what is in it is removed when the process ends."""
    path = os.path.join(checkpoint_dir(spark), f"ratewise-{name}-{uuid.uuid4().hex[:12]}")
    _scratch.append((spark, path))
    return path


def open_folder(path: str):
    """File system and path of a folder in the shared location, for a task that
    reads files there (``file:/x`` as Hadoop prints it is taken too)."""
    from pyarrow.fs import FileSystem
    return FileSystem.from_uri(f"file://{path}" if path.startswith("/") else re.sub(r"^file:/+", "file:///", path))


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _remove_scratch() -> None:
    for spark, path in _scratch:
        try:
            if spark.sparkContext._jsc is not None:
                remove_path(spark, path)
        except Exception:  # the session may be gone; these are only scratch
            continue


def materialise(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` once as Parquet in a scratch folder and read it back:
    columns are pruned and filters pushed in every later use, and a lost
    executor does not send work back to the inputs."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_materialised(df: DataFrame) -> None:
    """Remove the folder of a frame made by ``materialise``; it can't be read after that."""
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        remove_path(df.sparkSession, folder)


def drop_unused(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffles that nothing refers to any more
    now, not at the JVM's next full collection: what comes next needs the disk."""
    gc.collect()  # frames in Python's own reference cycles hold theirs
    spark.sparkContext._jvm.System.gc()


MB = 1 << 20


def scale_settings(input_bytes: int, cores: int, partition_bytes: int = 256 * MB,
                   max_partitions: int = 100_000) -> dict[str, str]:
    """Session settings sized from the input, for a cluster run.

    The initial shuffle partition count gives each reducer about
    ``partition_bytes`` of input (at least two per core, capped); AQE then
    coalesces small partitions towards the same advisory size and splits
    skewed join partitions, so one hot key does not become one huge task.
    Scan splits match the partition size, so a task's input fits executor
    memory with room to spill.
    """
    parts = max(2 * cores, min(max_partitions, -(-input_bytes // partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    """Set the runtime-changeable SQL settings on a live session."""
    for k, v in settings.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
