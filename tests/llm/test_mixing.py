from __future__ import annotations

import numpy as np
import pytest

from martloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, copies string"


def water_level(sizes: dict, weights: dict) -> dict:
    """Share by weight, cap at three times the size, share the excess again until none is above."""
    out, open_, left = {}, set(sizes), float(sum(sizes.values()))
    while open_:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@pytest.fixture(scope="module")
def docs(spark):
    random = np.random.default_rng(5)
    rows = []
    for source, n in (("a", 400), ("b", 5), ("c", 300), ("d", 3), (None, 60), ("e", 1)):
        rows += [(i, " ".join(["w"] * int(random.geometric(0.02))), source, "x") for i in range(n)]
    rows += [(None, None, "a", None), (1, "", "e", None), (2, "long " * 20_000, "c", None)]
    rows += [(7, "twin words here", "c", None)] * 40
    return spark.createDataFrame(rows, SCHEMA)


def test_targets_totals_and_limits(docs):
    found = mixing.mixed(docs, block=100).toPandas()
    assert len(found) == docs.count()
    found["source"] = found["source"].fillna("~null")
    sizes = found.groupby("source")["size"].sum().to_dict()
    weights = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes))}
    wanted = water_level(sizes, weights)
    assert found.groupby("source")["target"].first().to_dict() == pytest.approx(wanted)
    assert found.groupby("source")["source_size"].first().to_dict() == sizes
    assert (found["taken"] == found["size"] * found["copies"]).all() and (found["copies"] <= 3).all()
    for source, rows in found.groupby("source"):
        if len(rows) > 50:
            assert abs(rows["taken"].sum() - wanted[source]) <= max(60, 0.01 * wanted[source])
        rate = wanted[source] / max(sizes[source], 1)
        assert rows["copies"].between(np.floor(rate - 1e-9), np.ceil(rate + 1e-9)).all()


def test_reruns_agree_however_rows_are_dealt(docs):
    key = ["doc_id", "source", "size", "copies"]
    first = mixing.mixed(docs, block=100).select(key).toPandas().sort_values(key).reset_index(drop=True)
    again = mixing.mixed(docs.repartition(5), block=100).select(key).toPandas().sort_values(key).reset_index(drop=True)
    assert first.equals(again)


def test_the_mix_holds_the_rows_taken(docs):
    whole = mixing.mixed(docs, block=100)
    taken = mixing.mix(docs, block=100)
    assert taken.columns == ["doc_id", "text", "source", "copies"]
    assert taken.agg({"copies": "sum"}).first()[0] == whole.agg({"copies": "sum"}).first()[0]
    assert taken.count() == whole.filter("copies > 0").count()


def test_draws_keep_probabilities_and_totals():
    random = np.random.default_rng(0)
    size = np.sort(random.integers(1, 2000, 200).astype(float))[::-1]
    p = np.full(200, 0.37)
    times = np.zeros(200)
    for seed in range(300):
        drawn = mixing.draw(size, p, np.random.default_rng(seed))
        assert set(np.unique(drawn)) <= {0.0, 1.0}
        assert abs(drawn.sum() - p.sum()) <= 4 and abs((size * (drawn - p)).sum()) <= 150
        times += drawn
    assert abs(times / 300 - 0.37).max() < 0.15


def test_empty_and_wordless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mixed(empty).count() == 0 and mixing.mix(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None, None), (2, " \n", "s", None)], SCHEMA)
    assert [(r.size, r.target, r.taken) for r in mixing.mixed(blank).collect()] == [(0, 0.0, 0)] * 2
