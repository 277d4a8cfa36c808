"""Intermediate tables in the shared folder of the cluster: they cut lineage and outlive lost executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from martloom.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once and read back from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Make a session ready for this package's Python tasks.

    Texts are read and handed to Python a few MB at a time, however long they are (a text longer than
    that, alone).
    Where the package was merely put on the driver's path, it is sent to the tasks, as --py-files would.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "512")
    root, context = Path(__file__).resolve().parents[2], spark.sparkContext
    known = str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if known or not root.is_dir() or context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    path = f"{tempfile.mkdtemp(prefix='martloom-code-')}/martloom.zip"  # Spark's file server reads it as long as it runs
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted((root / "martloom").rglob("*.py")):
            archive.write(file, file.relative_to(root))
    context.addPyFile(path)


def free(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that ``df`` does not have, whatever case its own are in."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def widened(schema: StructType, more: str) -> StructType:
    """A schema with further columns, given as DDL."""
    return StructType([*schema.fields, *StructType.fromDDL(more).fields])
