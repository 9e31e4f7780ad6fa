"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_folder: str | None = None
_staged: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without the setting gets a temporary folder of its own; on a cluster
    such a folder would be lost with its machine, so the missing setting is an error there.
    """
    global _local_folder
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="tablelab-")
    return _local_folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never used path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage", schema: StructType | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors.

    ``schema``: types to read it back with, if other than those of ``df``. ``compression``: codec, if other than the session's.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    _staged.append(path)
    out = df.sparkSession.read.schema(schema or df.schema).parquet(path)
    out.__dict__["staged_at"] = path
    return out


def release(spark: SparkSession, *staged: DataFrame) -> None:
    """Delete the ``staged`` tables, and let go of shuffle files that no frame needs any more.

    Spark deletes the files of a shuffle once the driver's garbage collector has found its frames; a driver with much free
    memory would otherwise keep those of all steps until the end.
    """
    for df in staged:
        path = df.__dict__["staged_at"]
        _staged.remove(path)
        _delete(spark, path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables this process has staged, once no frame built on them is needed any more."""
    n = len(_staged)
    while _staged:
        _delete(spark, _staged.pop())
    return n


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep ``df`` in memory or on disk while an iterative fit runs over it."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def small_side(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast of ``df`` only after measuring it; a larger table is returned as it is.

    The measurement reads at most ``max_rows + 1`` rows. Beyond either bound the planner keeps its
    own choice, normally a shuffled join.
    """
    from pyspark.sql import functions as F

    n, size = (
        df.limit(max_rows + 1)
        .select(F.octet_length(F.to_json(F.struct("*"))).alias("b"))
        .agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0)))
        .first()
    )
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


def dealt(df: DataFrame, rows: int, *keys: str, per_task: int = 1_000_000) -> DataFrame:
    """Deal ``df`` out by ``keys`` when its ``rows`` are more than ``per_task`` for each shuffle partition of the session.

    The number of partitions then follows the rows, so what one task sorts or aggregates does not grow with the table.
    """
    parts = -(-rows // per_task)
    return df.repartition(parts, *keys) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df
