"""Exact top-k search by exhaustive term-at-a-time accumulation.

Rows are packed into blocks of postings: for each term, the rows that hold it and their weights.
Every block of queries meets every block of candidates once.  There, each term's postings, weighted
by each query that holds the term, are scattered into a dense array of scores; the best k of a block
are taken by partition selection, and the best of the blocks are merged.

Nothing is pruned, so the result is exact.  A task holds one block of queries, one of candidates and
a slice of their scores, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.scratch import prepare, stored

_BLOCK = "ids binary, rows binary, terms binary, places binary, weights binary"
_PARTS = ("ids", "rows", "terms", "places", "weights")
#: Tasks among which the candidates of a query block are dealt.
SPREAD = 32
#: Scores held at once: so many queries by the candidates of a block.
_SLICE = 128


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``embedding`` as whole numbers: floor(scale * x), x as double.

    Vectors that are null, or hold a null or a component that is not finite, are left out, like rows
    without ``vec_id``.  Numbers beyond the range of a long become its nearest end.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    high, low = F.lit(float(2**63)), F.lit(-float(2**63))
    whole = F.transform(
        x,
        lambda v: F.when(v * scale >= high, F.lit(2**63 - 1))
        .when(v * scale <= low, F.lit(-(2**63)))
        .otherwise(F.floor(v * scale).cast("long")),
    )
    return vectors.filter(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("id"), whole.alias("weights")
    )


def top_k(rows: DataFrame, asks: Column, k: int = 5, block_rows: int = 4096) -> DataFrame:
    """The k candidates with the highest inner product for each query.

    ``rows``: id long, weights array<long>, the weight of each term (a shorter array lacks the last
    terms, which then weigh nothing).  ``asks``: which rows are queries.  Candidates of a query are
    all rows but itself; rows that repeat an id are rows of their own, each a query and a candidate.
    Ties go to the smaller id.  Returns query_id, row (a number of the query row), rank from 1,
    vec_id, score; an empty table gives an empty result.  A product beyond a long becomes its end.
    """
    prepare(rows.sparkSession)
    numbered = stored(rows.select("id", "weights", asks.alias("ask"), F.monotonically_increasing_id().alias("row")), "topk-rows")
    candidates = numbered.select("id", "row", "weights").mapInArrow(_pack(block_rows), _BLOCK)
    asking = numbered.filter("ask").select("id", "row", "weights")
    asking_blocks = max(1, -(-asking.count() // block_rows))
    queries = (
        asking.withColumn("n", F.pmod(F.xxhash64("row"), F.lit(asking_blocks)))
        .groupBy("n")
        .applyInArrow(_pack_group, "n long, " + ", ".join(f"q_{x}" for x in _BLOCK.split(", ")))
    )
    # Each query block meets the candidates in SPREAD tasks, each candidate block every query block.
    candidates = candidates.withColumns({"n": _numbers(asking_blocks), "part": F.pmod(F.xxhash64("ids"), F.lit(SPREAD))})
    met = candidates.join(queries.withColumn("part", _numbers(SPREAD)), ["n", "part"])
    best = met.mapInArrow(_score(k), "query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "row", "rank", "vec_id", "score")


def _numbers(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))


def _block(part: pa.RecordBatch | pa.Table) -> dict[str, list[bytes]]:
    """Postings sorted by term: the places in the block that hold the term, and their weights."""
    ids, rows = (np.asarray(part.column(c).to_numpy(), np.int64) for c in ("id", "row"))
    lists = part.column("weights")
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    place = np.repeat(np.arange(len(ids)), sizes)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    held = np.flatnonzero(flat)
    order = held[np.argsort(term[held], kind="stable")]
    arrays = (ids, rows, term[order].astype(np.int32), place[order].astype(np.int32), flat[order])
    return {name: [array.tobytes()] for name, array in zip(_PARTS, arrays)}


def _pack(block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                yield pa.RecordBatch.from_pydict(_block(batch.slice(at, block_rows)))

    return run


def _pack_group(rows: pa.Table) -> pa.Table:
    packed = {f"q_{name}": value for name, value in _block(rows).items()}
    return pa.table({"n": rows.column("n").slice(0, 1).combine_chunks()} | packed)


def _score(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield from _block_pair({name: batch.column(name)[row].as_py() for name in batch.schema.names}, k)

    return run


def _block_pair(one: dict, k: int) -> Iterator[pa.RecordBatch]:
    kinds = (np.int64, np.int64, np.int32, np.int32, np.int64)
    ids, rows, terms, places, weights = (np.frombuffer(one[c], t) for c, t in zip(_PARTS, kinds))
    q_ids, q_rows, q_terms, q_places, q_weights = (np.frombuffer(one[f"q_{c}"], t) for c, t in zip(_PARTS, kinds))
    exact = _fits(weights, q_weights, terms)
    width = 1 + int(max(terms.max(initial=-1), q_terms.max(initial=-1)))
    edge, q_edge = np.searchsorted(terms, np.arange(width + 1)), np.searchsorted(q_terms, np.arange(width + 1))
    for low in range(0, len(q_ids), _SLICE):
        count = min(_SLICE, len(q_ids) - low)
        scores = np.zeros((count, len(ids)), np.int64 if exact else object)
        for term in range(width):
            docs, w = places[edge[term] : edge[term + 1]], weights[edge[term] : edge[term + 1]]
            of = slice(q_edge[term], q_edge[term + 1])
            here = (q_places[of] >= low) & (q_places[of] < low + count)
            if not len(docs) or not here.any():
                continue
            w = w if exact else w.astype(object)
            whole = len(docs) == len(ids)  # every candidate holds the term: its postings are the whole line
            for q, x in zip((q_places[of][here] - low).tolist(), q_weights[of][here].tolist()):
                if whole:
                    scores[q] += w * x
                else:
                    scores[q, docs] += w * x
        if not exact:
            scores = np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64)
        own = rows[None, :] == q_rows[low : low + count, None]
        yield _selected(scores, own, ids, q_ids[low : low + count], q_rows[low : low + count], k)


def _fits(weights: np.ndarray, q_weights: np.ndarray, terms: np.ndarray) -> bool:
    """Whether no sum can leave 64 bits."""
    most = max((abs(int(x)) for x in (weights.max(initial=0), weights.min(initial=0))), default=0)
    q_most = max((abs(int(x)) for x in (q_weights.max(initial=0), q_weights.min(initial=0))), default=0)
    return most * q_most * (int(terms.max(initial=0)) + 1) < 2**63


def _selected(scores, own, ids, q_ids, q_rows, k: int) -> pa.RecordBatch:
    """The best k of each line: a partition finds the k-th score, what ties with it is sorted by id."""
    out_q, out_r, out_v, out_s = [], [], [], []
    for i in range(len(scores)):
        open_ = np.flatnonzero(~own[i])
        line = scores[i, open_]
        if len(open_) > k:
            least = np.partition(line, len(line) - k)[len(line) - k]
            keep = line >= least
            open_, line = open_[keep], line[keep]
        best = np.lexsort((ids[open_], ~line))[:k]  # ~ turns the order without overflow
        out_q.append(np.full(len(best), q_ids[i]))
        out_r.append(np.full(len(best), q_rows[i]))
        out_v.append(ids[open_[best]])
        out_s.append(line[best])
    names = ("query_id", "row", "vec_id", "score")
    return pa.RecordBatch.from_pydict({n: pa.array(np.concatenate(x), pa.int64()) for n, x in zip(names, (out_q, out_r, out_v, out_s))})
