"""Left lookups of dimension columns from a large table, safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from martloom.session import checkpoint

# What the broadcast tables of one call may take together; the driver and every executor hold them.
# The session may name another limit.
BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_SETTING = "spark.martloom.lookup.broadcastBytes"
# A row of a broadcast hash table, beside its values.
ROW_OVERHEAD = 64


@dataclass(frozen=True)
class Lookup:
    """``columns`` of the ``dimension`` row that has the same ``on``, a column unique in it."""

    dimension: DataFrame
    on: str
    columns: Sequence[str]

    @property
    def rows(self) -> DataFrame:
        return self.dimension.select(self.on, *self.columns)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` as a hash table: strings by their length, other columns by their type, and
    what each row takes beside them."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    width = F.lit(ROW_OVERHEAD + 8 * len(df.columns)).cast("long")
    for text in texts:
        width = width + F.coalesce(F.octet_length(text), F.lit(0))
    return df.agg(F.sum(width)).first()[0] or 0


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    on: str,
    columns: Sequence[str],
    spread_by: str,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """One lookup, as ``lookups`` does them."""
    return lookups(facts, [Lookup(dimension, on, columns)], spread_by, broadcast_bytes)


def lookups(
    facts: DataFrame, wanted: Sequence[Lookup], spread_by: str, broadcast_bytes: int | None = None
) -> DataFrame:
    """``facts`` with the columns of every lookup, NULL where a dimension has no such row.

    Dimensions are measured, and broadcast, the smallest first, while they fit together; a broadcast
    moves no fact. For the others, ``spread_by``, a column with many values, spreads the facts of hot
    keys. Finding those reads the key columns of ``facts`` once more, so they should be a stored table.
    """
    if broadcast_bytes is None:
        broadcast_bytes = int(facts.sparkSession.conf.get(BROADCAST_SETTING, str(BROADCAST_BYTES)))
    left, small = broadcast_bytes, set()
    for size, i in sorted((measured_bytes(x.rows), i) for i, x in enumerate(wanted)):
        if size <= left:
            left -= size
            small.add(i)
    large = [x for i, x in enumerate(wanted) if i not in small]
    hot = _hot_keys(facts, [x.on for x in large]) if large else {}
    found = facts
    for x in (wanted[i] for i in sorted(small)):
        found = found.join(F.broadcast(x.rows), x.on, "left")
    for x in large:
        found = _lookup_spread(found, x, hot[x.on], spread_by)
    return found


def _hot_keys(facts: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """The keys of each column with more than an even share of one shuffle partition.

    There cannot be more of them than partitions. Counted in one pass, before any join.
    """
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns)))
    counts = facts.select(keys.alias("key")).groupBy("key.c", "key.v").agg(F.count("*").alias("n"))
    counts = checkpoint(counts)
    totals = counts.groupBy("c").agg(F.sum("n").alias("all"))
    counts = checkpoint(counts.join(F.broadcast(totals), "c").filter(F.col("n") > F.col("all") / parts))
    return {
        c: counts.filter((F.col("c") == c) & F.col("v").isNotNull()).select(F.col("v").cast(facts.schema[c].dataType).alias(c))
        for c in columns
    }


def _lookup_spread(facts: DataFrame, wanted: Lookup, hot: DataFrame, spread_by: str) -> DataFrame:
    """Shuffled lookup in which no key can fill one task.

    The dimension rows of hot keys are broadcast. Their facts, and facts without a key, have nothing
    left to find and are spread over all partitions.
    """
    dimension, on, columns = wanted.rows, wanted.on, wanted.columns
    hot_members = dimension.join(F.broadcast(hot), on, "left_semi")
    hot = hot.join(F.broadcast(hot_members), on, "left").select(
        F.col(on).alias("_hot_key"), *(F.col(c).alias(f"_hot_{c}") for c in columns)
    )
    marked = facts.join(F.broadcast(hot), F.col(on) == F.col("_hot_key"), "left")
    settled = F.col("_hot_key").isNotNull() | F.col(on).isNull()
    # One joint column: as two, the constant on the side of the dimension would be optimized
    # away, and the spread with it.
    place = F.struct(
        F.when(~settled, F.col(on)).alias("key"),
        F.when(settled, F.xxhash64(spread_by)).otherwise(F.lit(0).cast("long")).alias("spread"),
    )
    cold = dimension.filter(F.col(on).isNotNull()).select(
        F.struct(F.col(on).alias("key"), F.lit(0).cast("long").alias("spread")).alias("_place"),
        *(F.col(c).alias(f"_cold_{c}") for c in columns),
    )
    found = (F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in columns)
    return marked.withColumn("_place", place).join(cold, "_place", "left").select(*facts.columns, *found)
