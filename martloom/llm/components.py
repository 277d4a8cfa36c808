"""Connected components of a graph given as links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.scratch import stored


def components(links: DataFrame) -> DataFrame:
    """node and class, the least node it is connected with, for each end of ``links`` (a, b).

    Each step replaces links by links to the least neighbour (Kiveris et al., 2014), which keeps what
    is connected; their number does not grow, and after about log(n) steps every node is linked to the
    least of its component alone.  Neighbours are only ever aggregated and joined, never gathered.
    """
    now = stored(_tidy(links.select("a", "b")), "links")
    size = _mark(now)
    while size[0]:
        large = _tidy(_star(now, larger_only=True))
        after = stored(_tidy(_star(large, larger_only=False)), "links")
        size, before = _mark(after), size
        now = after
        if size == before:
            break
    low = now.select(F.col("b").alias("node"), F.col("a").alias("class"))
    return low.union(now.select(F.col("a"), F.col("a"))).distinct().groupBy("node").agg(F.min("class").alias("class"))


def _tidy(links: DataFrame) -> DataFrame:
    """Each link once, from its smaller to its larger end."""
    return links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _mark(links: DataFrame) -> tuple:
    """Number and sum of hashes of the links: equal if nothing changed."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _star(links: DataFrame, larger_only: bool) -> DataFrame:
    """Link the larger neighbours (large star), or the smaller ones and the node itself (small star), to the least."""
    if larger_only:
        both = links.union(links.select(F.col("b"), F.col("a"))).toDF("node", "near")
        least = both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("least"))
        joined = both.join(least, "node").filter("near > node")
        return joined.select(F.col("near").alias("a"), F.col("least").alias("b"))
    down = links.select(F.col("b").alias("node"), F.col("a").alias("near"))
    least = down.groupBy("node").agg(F.min("near").alias("least"))
    joined = down.join(least, "node")
    return joined.select(F.col("near").alias("a"), F.col("least").alias("b")).union(least.select("node", "least"))
