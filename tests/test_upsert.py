from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.operators.upsert import dedupe_latest, upsert

DDL = "id string, value int, note string, made string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_updates_inserts_and_keeps(spark):
    target = spark.createDataFrame([("a", 1, "x", "t"), ("b", 2, "y", "t")], DDL)
    source = spark.createDataFrame([("b", 3, None, "s"), ("c", 4, "z", "s")], DDL)
    assert rows(upsert(target, source, "id")) == [
        ("a", 1, "x", "t"),
        ("b", 3, None, "s"),  # a NULL in the source replaces a value
        ("c", 4, "z", "s"),
    ]


def test_preserved_column_keeps_the_first_value(spark):
    target = spark.createDataFrame([("a", 1, "x", "first"), ("n", 1, "x", None)], DDL)
    source = spark.createDataFrame([("a", 2, "y", "second"), ("b", 5, "y", "second"), ("n", 2, "y", "second")], DDL)
    assert rows(upsert(target, source, "id", preserve=["made"])) == [
        ("a", 2, "y", "first"),
        ("b", 5, "y", "second"),
        ("n", 2, "y", None),  # preserved although it is NULL
    ]


def test_rows_without_key_never_match(spark):
    target = spark.createDataFrame([(None, 1, "x", "t"), ("a", 1, "x", "t")], DDL)
    source = spark.createDataFrame([(None, 2, "y", "s"), (None, 2, "y", "s"), ("a", 2, "y", "s")], DDL)
    assert rows(upsert(target, source, "id")) == sorted(
        [("a", 2, "y", "s"), (None, 1, "x", "t"), (None, 2, "y", "s"), (None, 2, "y", "s")], key=str
    )
    assert rows(upsert(target, source, "id", null_keys="drop")) == [("a", 2, "y", "s"), (None, 1, "x", "t")]


def test_repeated_key_fails_or_is_reduced(spark):
    target = spark.createDataFrame([("a", 1, "x", "t")], DDL)
    source = spark.createDataFrame(
        [("b", 1, "old", "s", 1), ("b", 2, "new", "s", 2), ("c", 3, "only", "s", 1)], DDL + ", delivered int"
    )
    with pytest.raises(Exception, match="upsert source repeats id b"):
        upsert(target, source, "id").collect()
    with pytest.raises(Exception, match="upsert source repeats id b"):
        upsert(target, source, "id").count()
    latest = upsert(target, source, "id", on_duplicate="latest", order_by=[F.desc("delivered")])
    assert rows(latest) == [("a", 1, "x", "t"), ("b", 2, "new", "s"), ("c", 3, "only", "s")]


def test_source_columns_are_taken_by_name_and_cast(spark):
    target = spark.createDataFrame([], "id string, amount double")
    source = spark.createDataFrame([(7, "a")], "amount int, id string")
    merged = upsert(target, source, "id")
    assert merged.schema.simpleString() == "struct<id:string,amount:double>"
    assert rows(merged) == [("a", 7.0)]


def test_wrong_options_are_refused(spark):
    df = spark.createDataFrame([("a", 1, "x", "t")], DDL)
    with pytest.raises(ValueError):
        upsert(df, df, "id", null_keys="ignore")
    with pytest.raises(ValueError):
        upsert(df, df, "id", on_duplicate="first")
    with pytest.raises(ValueError):
        upsert(df, df, "id", on_duplicate="latest")


def test_dedupe_keeps_every_row_without_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), (None, 1)], "id string, n int")
    assert rows(dedupe_latest(df, "id", [F.desc("n")])) == [("a", 2), (None, 1), (None, 1)]
    assert rows(dedupe_latest(df, "id", [F.desc("n")], null_keys="drop")) == [("a", 2)]


BATCH = st.lists(st.tuples(st.sampled_from("abcdef"), st.one_of(st.none(), st.integers(0, 9))), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=BATCH, second=BATCH)
def test_two_batches_give_the_latest_row_per_key(spark, first, second):
    ddl = "id string, n int, seq int"
    batches = [
        spark.createDataFrame([(k, n, i) for i, (k, n) in enumerate(batch)], ddl) for batch in (first, second)
    ]
    table = spark.createDataFrame([], "id string, n int")
    for batch in batches:
        table = upsert(table, batch, "id", on_duplicate="latest", order_by=[F.desc("seq")])
    assert rows(table) == sorted(({**dict(first), **dict(second)}).items(), key=str)
