from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

from martloom.session import tune


def local_session() -> SparkSession:
    folder = tempfile.mkdtemp(prefix="martloom-test-")
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("martloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/checkpoint")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return local_session()
