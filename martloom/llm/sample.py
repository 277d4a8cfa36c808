"""Which rows a model may learn from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.scratch import free

#: Groups a sample may be drawn from, each by itself.
GROUPS = 1_000


def remainder(mod: int) -> Column:
    """crc32 of doc_id as text, modulo ``mod``; null for a row without doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod


def held_out(mod: int, rest: int) -> Column:
    """Rows kept from training.  A row without doc_id is neither held out nor learned from."""
    return F.coalesce(remainder(mod) == rest, F.lit(False))


def learnable(mod: int, rest: int) -> Column:
    return F.coalesce(remainder(mod) != rest, F.lit(False))


def bounded(df: DataFrame, rows: int, *keys: str, each: str | None = None) -> DataFrame:
    """About ``rows`` rows, all if there are fewer; with ``each``, about so many for every value of that column.

    Rows that agree in all keys count once.  They are drawn by a hash of the keys, so the choice depends on the
    values alone and not on how large the rest of the table is; the share drawn follows from a sketch of how many
    different rows there are, and no row is sorted or gathered for it.  With ``each`` there may be at most
    ``GROUPS`` values, which are few by nature (labels); more of them are an error.
    """
    hashed, group = free(df, "hash", "group")
    drawn = df.withColumns({hashed: F.xxhash64(*keys, F.lit("sample")), group: F.col(each) if each else F.lit(0)})
    different = drawn.groupBy(group).agg(F.approx_count_distinct(hashed, 0.02).alias("n")).limit(GROUPS + 1).collect()
    if len(different) > GROUPS:
        raise ValueError(f"{each} has more than {GROUPS} values")
    shares = {value: rows / n for value, n in different if n > rows}
    least = F.lit(2**63 - 1)
    if None in shares:
        least = F.when(F.col(group).isNull(), _at(shares.pop(None))).otherwise(least)
    if shares:
        last = F.create_map(*(F.lit(x) for value, share in shares.items() for x in (value, _at(share))))
        least = F.coalesce(last[F.col(group)], least)
    first = drawn.filter(F.col(hashed) <= least).dropDuplicates([group, hashed])
    return first.drop(hashed, group)


def _at(share: float) -> int:
    """The hash below which this share of all hashes lies."""
    return int(share * 2**64) - 2**63
