"""Keyed upsert: what a MERGE does, as a join that gives the new contents of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def dedupe_latest(
    df: DataFrame, key: str, order_by: Sequence[Column | str], null_keys: str = "keep"
) -> DataFrame:
    """Keep, per key, the row that comes first in ``order_by``; rows without a key are all kept
    or all dropped.

    ``row_number() = 1`` lets Spark keep one row per key already before the shuffle, so a key
    that holds a large share of the rows costs one row per task.
    """
    keyed = _first_per_key(df.filter(F.col(key).isNotNull()), key, order_by)
    if null_keys == "drop":
        return keyed
    return keyed.unionByName(df.filter(F.col(key).isNull()))


def one_row_per_key(
    source: DataFrame,
    key: str,
    on_duplicate: str = "error",
    order_by: Sequence[Column | str] = (),
) -> DataFrame:
    """The rows that have a key, each key once.

    A key that comes twice fails the job (``on_duplicate="error"``) or is reduced to the first
    row in ``order_by`` (``"latest"``); ``"unique"`` says that none does.
    """
    keyed = source.filter(F.col(key).isNotNull())
    if on_duplicate == "unique":
        return keyed
    if on_duplicate == "latest":
        return _first_per_key(keyed, key, order_by)
    if on_duplicate == "error":
        return _assert_one_per_key(keyed, key)
    raise ValueError(f"on_duplicate must be error, latest or unique, not {on_duplicate!r}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    preserve: Sequence[str] = (),
    on_duplicate: str = "error",
    order_by: Sequence[Column | str] = (),
    null_keys: str = "keep",
) -> DataFrame:
    """Contents of ``target`` after merging ``source`` into it on ``key``.

    A matched row takes every column from the source, NULLs included, except those in
    ``preserve``; unmatched rows of either side are kept. Rows without a key never match:
    those of the source are added (``null_keys="keep"``) or left out (``"drop"``).
    Repeated keys in the source are treated as in ``one_row_per_key``; ``order_by`` may use
    source columns the target does not have.
    """
    if null_keys not in ("keep", "drop"):
        raise ValueError(f"null_keys must be keep or drop, not {null_keys!r}")
    keyed = conform(one_row_per_key(source, key, on_duplicate, order_by), target.schema)
    if null_keys == "drop":
        return _merge(target, keyed, key, preserve)
    # NULL keys would all meet in one task of the join, where they cannot match anyway.
    return (
        _merge(target.filter(F.col(key).isNotNull()), keyed, key, preserve)
        .unionByName(target.filter(F.col(key).isNull()))
        .unionByName(conform(source.filter(F.col(key).isNull()), target.schema))
    )


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, by name, in its types and order."""
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def _merge(target: DataFrame, source: DataFrame, key: str, preserve: Sequence[str]) -> DataFrame:
    old = target.withColumn("_in_target", F.lit(True)).alias("old")
    new = source.withColumn("_in_source", F.lit(True)).alias("new")
    had = F.col("old._in_target").isNotNull()
    came = F.col("new._in_source").isNotNull()

    def pick(name: str) -> Column:
        if name in preserve:
            return F.when(had, F.col(f"old.{name}")).otherwise(F.col(f"new.{name}")).alias(name)
        return F.when(came, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    return joined.select(*(pick(name) for name in target.columns))


def _first_per_key(df: DataFrame, key: str, order_by: Sequence[Column | str]) -> DataFrame:
    if not order_by:
        raise ValueError("choosing one row per key needs an order")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _assert_one_per_key(df: DataFrame, key: str) -> DataFrame:
    # Grouped, not in a window: of a key that comes often one row for each task is moved and held, and
    # rows already grouped and sorted by key are neither moved nor sorted again.
    others = [c for c in df.columns if c != key]
    row = F.any_value(F.struct(*others) if others else F.lit(True)).alias("_row")
    message = F.concat(F.lit(f"upsert source repeats {key} "), F.col(key).cast("string"))
    once = F.when(F.col("_times") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    grouped = df.groupBy(key).agg(F.count("*").alias("_times"), row).filter(once)
    return grouped.select(*(key if c == key else F.col("_row").getField(c).alias(c) for c in df.columns))
