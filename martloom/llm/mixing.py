"""Mixing sources to target weights by cube-method balanced sampling.

Every document is taken a whole number of times and, with the rest of its source's rate as
probability, once more.  Those draws are made by the cube method (Deville and Tillé, 2004): the
vector of probabilities moves along directions that leave both the expected number of words and of
documents as they are, until each probability but two has become 0 or 1; these two are then settled
without the word total.  A block of documents is balanced from its longest to its shortest, one range
of lengths after the other, and each range starts with what the landings before it left owing.  So
only the shortest documents decide how far the totals of a block end from their expectation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.scratch import free, prepare, stored

#: Documents balanced in one task at a time.
BLOCK = 2_000
#: No document is taken more often than this.
MOST = 3
_EPS = 1e-9


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """What each source is to give: source, source_size, source_units, target.

    ``sizes``: source, size, n (how many rows are alike).  Sources in order of code point, null last,
    weigh 1, 2, 3, repeating, and share the total size by weight, none more than ``MOST`` times its
    own; the excess is shared again among the others.  So a source gets the smaller of that limit and
    its weight times one common level, which the windows find: they go over one row for each source,
    in order of the level at which the source is full.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("source_units"))
    weighed = per.withColumn("weight", (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % 3 + 1)
    full = Window.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    levels = (
        weighed.withColumn("limit", F.col("source_size") * float(MOST))
        .withColumn("before", F.sum("limit").over(full) - F.col("limit"))
        .withColumn("open", F.sum("weight").over(everything) - F.sum("weight").over(full) + F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(everything) - F.col("before")) / F.col("open"))
        .withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))).over(everything))
    )
    share = F.coalesce(F.least("limit", F.col("level") * F.col("weight")), F.lit(0.0))
    return levels.select("source", "source_size", "source_units", share.alias("target"))


def mixed(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """How often the mix takes each row of ``docs`` (doc_id, text, source; further columns are ignored).

    Returns doc_id, source, size, source_size, target, copies and taken (size times copies), one row for
    each row of ``docs``.  Rows alike in doc_id, source and text are drawn as one group, whose copies they
    share as evenly as can be; rows without text have size 0; doc_id and source may be null.  An empty
    table gives an empty mix, a source without words gives nothing.  Draws depend on the values of the
    rows alone, so reruns agree.
    """
    rows = _drawn(docs, block).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return rows.select("doc_id", "source", "size", "source_size", "target", _copies(F.col("i"), F.col("n"), F.col("times")).alias("copies")).withColumn("taken", F.col("size") * F.col("copies"))


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with ``copies``, how often (a column of that name is replaced)."""
    docs = docs.drop("copies")
    unit, n, times, i = free(docs, "unit", "n", "times", "i")
    drawn = _drawn(docs, block).select(F.col("unit").alias(unit), F.col("n").alias(n), F.col("times").alias(times))
    joined = docs.withColumn(unit, _unit()).join(drawn, unit).withColumn(i, F.row_number().over(Window.partitionBy(unit).orderBy(unit)))
    return joined.withColumn("copies", _copies(F.col(i), F.col(n), F.col(times))).filter("copies > 0").drop(unit, n, times, i)


def _unit() -> Column:
    """Rows alike in doc_id, source and text have the same."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in ("doc_id", "source", "text")]
    return F.unhex(F.md5(F.concat_ws("\x02", *parts)))


def _copies(i: Column, n: Column, times: Column) -> Column:
    """Of the i-th of n rows alike, which are taken so many times together."""
    return (F.floor(times / n) + (i <= times % n).cast("long")).cast("long")


def _drawn(docs: DataFrame, block: int) -> DataFrame:
    """Groups of n rows alike: unit, doc_id, source, size, n, source_size, target, times."""
    prepare(docs.sparkSession)
    groups = docs.select(_unit().alias("unit"), "doc_id", "source", n_words(F.col("text")).alias("size"))
    units = stored(groups.groupBy("unit", "doc_id", "source", "size").agg(F.count("*").alias("n")), "mix-units")
    goals = stored(targets(units), "mix-targets").withColumnRenamed("source", "_of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = units.join(goals, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    # Of n rows alike, the whole part of n * rate is taken for sure; the rest is drawn.
    sure = F.floor(F.col("n") * rate + _EPS)
    chances = joined.withColumns(
        {
            "sure": sure,
            "p": F.greatest(F.col("n") * rate - sure, F.lit(0.0)),
            "order": F.xxhash64("unit"),
            "blocks": F.ceil(F.col("source_units") / block).cast("long"),
        }
    )
    part = F.pmod(F.xxhash64("order"), F.col("blocks"))
    drawn = chances.withColumn("part", part).groupBy("source", "part").applyInArrow(_draw(chances.columns), chances.schema)
    times = (F.col("sure") + F.col("p").cast("long")).alias("times")
    return drawn.select("unit", "doc_id", "source", "size", "n", "source_size", "target", times)


def _draw(columns: list[str]):
    def run(rows: pa.Table) -> pa.Table:
        size, p = rows.column("size").to_numpy().astype(float), rows.column("p").to_numpy()
        order = rows.column("order").to_numpy()
        turn = np.lexsort((order, -size))
        drawn = np.empty(len(p))
        drawn[turn] = draw(size[turn], p[turn], np.random.default_rng(int(np.bitwise_xor.reduce(order)) & (2**63 - 1)))
        return rows.drop_columns(["p", "part"]).append_column("p", pa.array(drawn)).select(columns)

    return run


def draw(size: np.ndarray, p: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """0 or 1 for each document, given longest first; sums of p and size * p stay as near as they can."""
    p = np.where(p < _EPS, 0.0, np.where(p > 1 - _EPS, 1.0, p))
    out, owed = p.copy(), np.zeros(2)
    open_ = np.flatnonzero((p > 0) & (p < 1))
    octave = np.floor(np.log2(size[open_] + 1))
    low = 0
    while low < len(open_):
        high = int(np.searchsorted(-octave, -octave[low], "right"))
        high = len(open_) if len(open_) - max(high, low + 8) < 8 else max(high, low + 8)
        here = open_[low:high]
        out[here] = balanced(size[here], _tilted(size[here], p[here], owed), random)
        missing = p[here] - out[here]
        owed += [missing.sum(), (size[here] * missing).sum()]
        low = high
    return out


def _tilted(size: np.ndarray, p: np.ndarray, owed: np.ndarray) -> np.ndarray:
    """Probabilities moved, most where they are least certain, to add what is owed in documents and words."""
    v = p * (1 - p)
    sums = np.array([[v.sum(), (v * size).sum()], [(v * size).sum(), (v * size * size).sum()]])
    if np.linalg.cond(sums) < 1e12:
        moved = p + v * (np.column_stack([np.ones(len(p)), size]) @ np.linalg.solve(sums, owed))
        if moved.min() >= 0 and moved.max() <= 1:
            return moved
    words = sums[1, 1]
    return np.clip(p + (v * size * owed[1] / words if words else 0), 0, 1)


def balanced(size: np.ndarray, p: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """The flight of the cube method, and the landing of what it leaves.

    Sums of p and of size * p stay as they were up to the landing, which keeps the sum of p as near as
    whole numbers can be.
    """
    p = np.where(p < _EPS, 0.0, np.where(p > 1 - _EPS, 1.0, p))
    values, sizes, chance = p.tolist(), size.tolist(), random.random(2 * len(p) + 2).tolist()
    waiting = [i for i in range(len(values)) if 0 < values[i] < 1]
    waiting.reverse()
    active: list[int] = []
    draws = iter(chance)
    while True:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) == 3:
            a, b, c = (sizes[i] for i in active)
            move = (c - b, a - c, b - a)  # leaves both sums unchanged
            if move == (0, 0, 0):
                move = (1.0, -1.0, 0.0)
        elif len(active) == 2:
            move = (1.0, -1.0)
        elif len(active) == 1:
            move = (1.0,)
        else:
            break
        up = min(((1 - values[i]) / u if u > 0 else values[i] / -u) for i, u in zip(active, move) if u)
        down = min((values[i] / u if u > 0 else (1 - values[i]) / -u) for i, u in zip(active, move) if u)
        step = up if next(draws) * (up + down) < down else -down
        still = []
        for i, u in zip(active, move):
            x = values[i] + step * u
            values[i] = x = 0.0 if x < _EPS else 1.0 if x > 1 - _EPS else x
            if 0 < x < 1:
                still.append(i)
        if len(still) == len(active):  # rounding kept the unit that should have ended
            nearest = min(still, key=lambda i: min(values[i], 1 - values[i]))
            values[nearest] = round(values[nearest])
            still.remove(nearest)
        active = still
    return np.array(values)
