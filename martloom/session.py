"""Session settings the jobs are written for, and the shared folder they may write scratch data to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings, so they can be applied to a session somebody else built.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A value out of range fails instead of turning into another one.
    "spark.sql.ansi.enabled": "true",
    # A bucket written as one sorted file is read back as sorted: merging two tables that share
    # a key then needs neither a shuffle nor a sort.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


Item, Result = TypeVar("Item"), TypeVar("Result")


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


_BUCKETS = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
_lock, _within = Lock(), 0


@contextmanager
def bucketed_scans(spark: SparkSession) -> Iterator[None]:
    """Within, a bucketed table is scanned bucket by bucket even where no join asks for it, so that
    what is derived from it is written back bucket by bucket without a shuffle. Elsewhere a scan may
    have more tasks than there are buckets. May be entered by several threads."""
    global _within
    with _lock:
        _within += 1
        spark.conf.set(_BUCKETS, "false")
    try:
        yield
    finally:
        with _lock:
            _within -= 1
            if not _within:
                spark.conf.set(_BUCKETS, "true")


@contextmanager
def shuffle_partitions(spark: SparkSession, number: int) -> Iterator[None]:
    """Within, shuffles have this number of partitions, before Spark puts small ones together."""
    with _within_setting(spark, "spark.sql.shuffle.partitions", str(number)):
        yield


@contextmanager
def small_scans(spark: SparkSession) -> Iterator[None]:
    """Within, a task reads no more than 16 MB of files, or one row group: what it sorts before a shuffle
    then fits its memory, however large the table."""
    with _within_setting(spark, "spark.sql.files.maxPartitionBytes", "16m"):
        yield


@contextmanager
def _within_setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    used = spark.sparkContext.getCheckpointDir()
    if used:
        # Spark gives every application a sub-folder of the checkpoint folder.
        return used.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="martloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/martloom/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder and read from there, column by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(job: Callable[[Item], Result], items: Iterable[Item]) -> dict[Item, Result]:
    """Run a job for every item, their Spark jobs sharing the cluster. The first error is raised."""
    items = list(items)
    with ThreadPoolExecutor() as pool:
        return dict(zip(items, pool.map(job, items)))
