from __future__ import annotations

import numpy as np
import pyarrow as pa

from martloom.llm import quality
from martloom.llm.queries import op6_quality


def test_features_of_odd_texts():
    x = quality.features(pa.array([None, "", "A b b\nA b b\n!!", "é" * 100_000, "\n\n"]))
    assert x.shape == (5, len(quality.FEATURES)) and np.isfinite(x).all()
    assert not x[0].any() and not x[1].any()
    named = dict(zip(quality.FEATURES, x[2]))
    assert named["distinct"] == 3 / 7 and named["commonest"] == 4 / 7 and named["same_as_last"] == 2 / 7
    assert named["distinct_lines"] == 2 / 3 and named["upper"] == 2 / 14


def test_features_do_not_depend_on_the_batch():
    texts = ["One two.", None, "three | three ###", "x"]
    whole = quality.features(pa.array(texts))
    assert np.allclose(whole, np.concatenate([quality.features(pa.array([t], pa.string())) for t in texts]))


def test_risk_from_positive_and_unlabelled_alone():
    random = np.random.default_rng(0)
    size = len(quality.FEATURES)
    good = lambda n: random.normal(0, 1, (n, size))
    bad = lambda n: random.normal(2, 1, (n, size))
    model = quality.learn(good(2000), np.concatenate([good(1400), bad(600)]), 0.7)
    assert (model.score(good(500)) > 0.3).mean() > 0.95 and (model.score(bad(500)) < 0.3).mean() > 0.95


GOOD, BAD = "the sea is deep and blue", "win a free prize now"


def said(about: str, i: int) -> str:
    """Texts of one shape: only their words tell them apart."""
    mixed = np.random.default_rng(i).permutation(about.split() * 3)
    return " ".join(mixed[:14])


def test_prior_is_that_of_all_unlabelled_texts(spark):
    # The sample is a twentieth of the corpus; the prior, and each count, come from all of it.
    docs = [(i, said(GOOD if i < 400 or i % 5 else BAD, i)) for i in range(4_400)]
    labels = spark.createDataFrame([(i, 1) for i in range(400)] + [(0, 1)], "doc_id long, quality int")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert 0.7 < quality.fit(frame, labels, fit_rows=200).prior < 0.9
    model = quality.separate(quality.features(pa.array([t for _, t in docs[:50]])), quality.features(pa.array([t for _, t in docs[400:500]])))
    folds = frame.selectExpr("doc_id", "text", "cast(doc_id % 3 = 0 AS int) AS fold").repartition(5)
    cuts = quality.thresholds(model.score(quality.features(pa.array([t for _, t in docs[:400]]))))
    for i, counted in enumerate(quality._histogram(folds, labels.filter("doc_id < 40"), [model, model], [cuts, cuts[::2]])):
        scores = model.score(quality.features(pa.array([t for d, t in docs if (d % 3 == 0) == i and d >= 40])))
        edges = [-1, *(cuts, cuts[::2])[i], 2]
        brute = [sum((a <= scores) & (scores < b)) for a, b in zip(edges, edges[1:])]
        assert counted.tolist() == brute


def test_words_tell_texts_of_one_shape_apart(spark):
    docs = [(i, said(GOOD if i < 400 or i % 2 else BAD, i)) for i in range(1_400)]
    docs += [(10_000, docs[0][1]), (0, docs[0][1]), (None, None)]  # repeated text, repeated document, no id
    labels = spark.createDataFrame([(i, 1) for i in range(400)] + [(5, 0), (None, 1)], "doc_id long, quality int")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = quality.fit(frame, labels)
    good, bad = (model.score(quality.features(pa.array([said(about, 9_000 + i) for i in range(200)]))) for about in (GOOD, BAD))
    assert (good >= 0.3).mean() > 0.95 and (bad < 0.3).mean() > 0.95


def test_without_positives_the_score_is_a_half(spark):
    docs = spark.createDataFrame([(1, "a", "old"), (None, None, None)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    assert {r.score for r in quality.scored(docs, model).collect()} == {0.5}
    assert quality.scored(docs.limit(0), model).count() == 0


def test_held_out_separation(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in op6_quality(spark, folder).collect() if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in rows)
    assert right >= 0.9 * len(rows)  # some 240 positives to learn from
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
