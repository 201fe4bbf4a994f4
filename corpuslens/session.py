"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by the cluster.

    Only where the key is unset on a local master, whose one process is all there is, a temporary folder stands in.
    """
    sc = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpuslens-"))
        folder = sc.getCheckpointDir()
    return folder


def working_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed when the session's JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/corpuslens/{name}-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def discard(spark: SparkSession, path: str) -> None:
    """Remove a path that `working_path` gave, before the session ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of each query of the block when it ends."""
    before = spark.conf.get(CLEANUP_KEY, "false")
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_KEY, before)


def cut_lineage(df: DataFrame, path: str | None = None, free: bool = False, **options: str) -> DataFrame:
    """Write `df` to the shared folder and read it from there.

    The data survives the loss of any executor, later steps read only the columns they need, and
    Spark knows its true size when it chooses joins. A caller that names the `path` can `discard` it.
    With `free`, Spark removes the shuffle files of the write when it ends, else when the driver happens to collect garbage.
    `options` are the writer's.
    """
    spark = df.sparkSession
    path = path or working_path(spark, "cut")
    with freed(spark) if free else nullcontext():
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, *keys: str) -> Iterator[DataFrame]:
    """`df` written to the shared folder in buckets, so that joins on `keys` need not shuffle it.

    The table and its files last as long as the block.
    """
    spark = df.sparkSession
    path = working_path(spark, "buckets")
    name = "buckets_" + uuid.uuid4().hex
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(spark, path)
