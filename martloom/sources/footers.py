"""Counts and extremes of stored tables from the footers of their files."""

from __future__ import annotations

from threading import Lock
from urllib.parse import unquote

from pyspark.sql import DataFrame

_V1, _PUSHED = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"
_lock = Lock()


def footers(stored: DataFrame) -> DataFrame:
    """The rows of a stored parquet table, read so that ``count(*)`` and the ``min`` and ``max`` of dates and
    numbers, over the whole table, come from what its files' footers say, and no row is read.

    Only Spark's newer parquet reader takes aggregates down to the files, so that one is chosen here.
    """
    spark = stored.sparkSession
    folders = sorted({unquote(file).rsplit("/", 1)[0] for file in stored.inputFiles()})
    if not folders:
        return spark.createDataFrame([], stored.schema)
    spark.conf.set(_PUSHED, "true")
    with _lock:
        older = spark.conf.get(_V1)
        spark.conf.set(_V1, ",".join(x for x in older.split(",") if x != "parquet"))
        try:
            return spark.read.schema(stored.schema).parquet(*folders)
        finally:
            spark.conf.set(_V1, older)
