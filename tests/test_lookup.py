from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martloom.operators import lookup as module
from martloom.operators.lookup import ROW_OVERHEAD, Lookup, lookup, lookups, measured_bytes


def facts(spark):
    """A third of the rows on one known key, a third on an unknown one, a sixth without key."""
    n = F.col("id")
    key = (
        F.when(n % 6 < 2, F.lit("hot"))
        .when(n % 6 < 4, F.lit("unknown"))
        .when(n % 6 == 4, F.concat(F.lit("k"), n % 50))
    )
    return spark.range(6000).select(F.concat(F.lit("t"), n).alias("TransactionID"), key.alias("code"))


def members(spark):
    rows = [(f"k{i}", i, f"name {i}") for i in range(0, 50, 4)] + [("hot", 99, None), ("idle", 98, "idle")]
    return spark.createDataFrame(rows, "code string, number int, name string")


def rows(df):
    return sorted(map(tuple, df.select("TransactionID", "code", "number", "name").collect()))


def test_spread_lookup_equals_broadcast_and_plain_join(spark):
    wanted = rows(facts(spark).join(members(spark), "code", "left"))
    for limit in (0, 1 << 20):
        found = lookup(facts(spark), members(spark), "code", ["number", "name"], "TransactionID", limit)
        assert rows(found) == wanted
    assert len(wanted) == 6000


def test_spread_lookup_leaves_no_partition_with_a_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = lookup(facts(spark), members(spark), "code", ["number", "name"], "TransactionID", 0)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 6000
    assert len(sizes) == 8
    assert max(sizes) < 2 * 6000 / 8


def test_small_dimension_is_broadcast(spark, capsys):
    lookup(facts(spark), members(spark), "code", ["number"], "TransactionID").explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out


def test_broadcasts_of_one_call_fit_together(spark, capsys):
    size = measured_bytes(members(spark).select("code", "number"))
    two = [Lookup(members(spark), "code", ["number"]), Lookup(members(spark).withColumnRenamed("number", "other"), "code", ["other"])]
    for limit, large in ((2 * size, 0), (2 * size - 1, 1), (size - 1, 2)):
        found = lookups(facts(spark), two, "TransactionID", limit)
        capsys.readouterr()
        found.explain()
        assert capsys.readouterr().out.count("SortMergeJoin") <= large
        assert found.filter("number <=> other").count() == 6000
        assert sorted(found.columns) == ["TransactionID", "code", "number", "other"]


def test_hot_keys_are_found_before_the_joins(spark):
    """Facts are read once for the hot keys of all columns: two scans, however many lookups."""
    stored_facts = facts(spark)
    reads = spark.sparkContext.accumulator(0)
    counted = stored_facts.mapInPandas(lambda parts: (reads.add(len(p)) or p for p in parts), stored_facts.schema)
    three = [Lookup(members(spark).select("code", F.col("number").alias(f"n{i}")), "code", [f"n{i}"]) for i in range(3)]
    lookups(counted, three, "TransactionID", 0).write.format("noop").mode("overwrite").save()
    assert reads.value == 2 * 6000


def test_hot_keys_are_found_without_a_window(spark, monkeypatch):
    """No task gets all distinct keys of a column."""
    plans = []
    monkeypatch.setattr(module, "checkpoint", lambda df: plans.append(df) or df)
    hot = module._hot_keys(facts(spark), ["code", "TransactionID"])
    assert {r.code for r in hot["code"].collect()} == {"hot", "unknown"} and hot["TransactionID"].count() == 0
    for df in (*plans, *hot.values()):
        assert "Window" not in df._jdf.queryExecution().toString()


def test_measured_bytes(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2), ("ü", None)], "text string, number int")
    assert measured_bytes(df) == 3 * (2 * 8 + ROW_OVERHEAD) + 2 + 2
    assert measured_bytes(df.limit(0)) == 0


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_empty_sides(spark, limit):
    assert lookup(facts(spark).limit(0), members(spark), "code", ["number"], "TransactionID", limit).count() == 0
    found = lookup(facts(spark), members(spark).limit(0), "code", ["number"], "TransactionID", limit)
    assert found.filter("number is null").count() == 6000
