from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from martloom.operators.keys import dense_key, scd1_dimension


def test_same_numbers_as_a_global_row_number(spark):
    ids = spark.range(5000).select(F.concat(F.lit("P"), F.col("id") * 7919 % 5000).alias("code"), "id")
    wanted = ids.withColumn("key", F.row_number().over(Window.orderBy("code")))
    # Without coalescing, so that there are several ranges.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = dense_key(ids, "code", "key")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found.columns == ["key", "code", "id"]
    assert dict(found.dtypes)["key"] == "int"
    assert found.rdd.getNumPartitions() > 1
    assert sorted(map(tuple, found.select("key", "code").collect())) == sorted(
        map(tuple, wanted.select("key", "code").collect())
    )


def test_offset_and_empty(spark):
    two = spark.createDataFrame([("b",), ("a",)], "code string")
    assert sorted(map(tuple, dense_key(two, "code", "key", 10).collect())) == [(11, "a"), (12, "b")]
    assert dense_key(two.limit(0), "code", "key").count() == 0


def test_new_member_sorting_first_does_not_take_a_used_key(spark):
    first = scd1_dimension(None, spark.createDataFrame([("b", 1), ("c", 2)], "id string, n int"), "id", "key")
    again = spark.createDataFrame([("a", 7), ("b", 5), ("c", None)], "id string, n int")
    second = scd1_dimension(first, again, "id", "key")
    assert sorted(map(tuple, second.select("key", "id", "n").collect())) == [(1, "b", 5), (2, "c", None), (3, "a", 7)]


def test_member_that_no_longer_comes_stays(spark):
    first = scd1_dimension(None, spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int"), "id", "key")
    second = scd1_dimension(first, spark.createDataFrame([("b", 3)], "id string, n int"), "id", "key")
    assert sorted(map(tuple, second.select("key", "id", "n").collect())) == [(1, "a", 1), (2, "b", 3)]


def test_first_load_into_an_empty_dimension(spark):
    empty = spark.createDataFrame([], "key int, id string, n int")
    loaded = scd1_dimension(empty, spark.createDataFrame([("b", 1), ("a", 2)], "id string, n int"), "id", "key")
    assert sorted(map(tuple, loaded.select("key", "id").collect())) == [(1, "a"), (2, "b")]
