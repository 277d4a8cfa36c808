"""Surrogate keys: a dense numbering without a single-task sort, and overwrite-style dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.upsert import upsert
from martloom.session import checkpoint

# monotonically_increasing_id() is the partition number above these bits and the row number in them.
_ROW_BITS = 33


def dense_key(df: DataFrame, order_by: str, name: str, offset: int = 0) -> DataFrame:
    """Number the rows 1, 2, 3, ... (plus ``offset``) in the order of a unique column.

    Same numbers as ``row_number()`` over the whole table, but every task sorts one range of
    the column: position in the range plus the number of rows in the ranges before it. The
    ranged rows are checkpointed, because ranges chosen again after a loss could differ.
    """
    placed = checkpoint(
        df.repartitionByRange(order_by)
        .sortWithinPartitions(order_by)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = placed.withColumn("_range", F.shiftright("_place", _ROW_BITS)).withColumn(
        "_position", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, so at most as many as there are shuffle partitions.
    starts = (
        placed.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    number = (F.col("_start") + F.col("_position") + 1 + offset).cast("int")
    return placed.join(F.broadcast(starts), "_range").select(number.alias(name), *df.columns)


def scd1_dimension(current: DataFrame | None, incoming: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Dimension contents after overwriting ``current`` with ``incoming``.

    Known members keep their surrogate key and take the new attributes; new members are
    numbered after the highest key in use, so a key never changes hands. The first load is
    numbered from 1 in the order of the business key.
    """
    if current is None:
        return dense_key(incoming, key, surrogate)
    unnumbered = incoming.withColumn(surrogate, F.lit(None).cast("int"))
    # Read three times below: highest key, members with a key, members without.
    merged = checkpoint(upsert(current, unnumbered, key, preserve=[surrogate]))
    highest = merged.agg(F.max(surrogate)).first()[0] or 0
    known = merged.filter(F.col(surrogate).isNotNull())
    fresh = merged.filter(F.col(surrogate).isNull()).drop(surrogate)
    return known.unionByName(dense_key(fresh, key, surrogate, highest))
