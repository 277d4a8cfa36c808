from __future__ import annotations

import random

from pyspark.sql import functions as F

from martloom.llm.topk import quantised, top_k

SCHEMA = "vec_id long, embedding array<double>, rank string"


def brute(rows: list[tuple[int, list[int]]], every: int, k: int) -> list[tuple]:
    found = []
    for at, (q, x) in enumerate(rows):
        if q % every == 0:
            scores = [(-sum(a * b for a, b in zip(x, y)), v) for i, (v, y) in enumerate(rows) if i != at]
            found += [(q, rank, v, -s) for rank, (s, v) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def test_as_brute_force_with_ties_repeats_and_sparse_rows(spark):
    random.seed(1)
    rows = [(i, [random.choice([0, 0, 0, -1, 1, 2]) for _ in range(random.choice([0, 3, 8]))]) for i in range(150)]
    rows += [(10, [1, 1]), (10, [1, 1]), (7, [2, 0, 1])]
    found = top_k(spark.createDataFrame(rows, "id long, weights array<long>"), F.col("id") % 10 == 0, k=4, block_rows=16)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()) == brute(rows, 10, 4)


def test_fewer_candidates_than_k_and_products_beyond_a_long(spark):
    big = 2**62
    rows = [(0, [big, 1]), (1, [big, 5]), (2, [-big, 0])]
    found = top_k(spark.createDataFrame(rows, "id long, weights array<long>"), F.col("id") == 0, k=5)
    assert [(r.rank, r.vec_id, r.score) for r in found.orderBy("rank").collect()] == [(1, 1, 2**63 - 1), (2, 2, -(2**63))]


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.001], "x"), (1, None, None), (2, [None, 1.0], ""), (3, [nan], ""), (4, [inf], ""), (None, [1.0], ""), (5, [1e300, -1e300], "")]
    got = {r.id: r.weights for r in quantised(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: [128, -1], 5: [2**63 - 1, -(2**63)]}


def test_empty_table(spark):
    assert top_k(quantised(spark.createDataFrame([], SCHEMA)), F.col("id") >= 0).count() == 0
