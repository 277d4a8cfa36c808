from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from martloom.llm import near
from martloom.llm.components import components

SCHEMA = "doc_id long, text string, class_id string, key string"


def shingles(text: str) -> Counter:
    w = text.lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a: Counter, b: Counter) -> float:
    smaller = sum((a & b).values())
    return smaller / max(sum(a.values()) + sum(b.values()) - smaller, 1)


def brute(texts: list) -> list[int]:
    """Least row of each row's class."""
    label = list(range(len(texts)))
    held = [shingles(t or "") for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            same = texts[i] is not None and texts[i] == texts[j]
            if same or (held[i] and held[j] and texts[i] is not None and similarity(held[i], held[j]) >= 0.8):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


def edited(words: list[str], n: int) -> str:
    words = list(words)
    for _ in range(n):
        words[random.randrange(len(words))] = f"e{random.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def texts() -> list:
    random.seed(2)
    vocabulary = [f"w{i}" for i in range(300)]
    rows: list = [None, None, "", "", "one", "One", "a b c d", "! ?"]
    for _ in range(25):
        base = random.choices(vocabulary, k=random.choice([12, 60, 200]))
        rows += [edited(base, random.randrange(12)) for _ in range(random.randrange(1, 8))] + [" ".join(base)] * random.randrange(3)
    hub = random.choices(vocabulary, k=150)
    rows += [edited(hub, random.randrange(1, 14)) for _ in range(60)] + ["same words again " * 30_000] * 2
    return rows


def test_classes_as_brute_force(spark, texts):
    frame = spark.createDataFrame([(i, t, "old", "x") for i, t in enumerate(texts)], SCHEMA)
    found = {r.doc_id: (r.class_id, r.class_size) for r in near.near_duplicates(frame).collect()}
    label = brute(texts)
    sizes = Counter(label)
    assert found == {i: (label[i], sizes[label[i]]) for i in range(len(texts))}
    kept = near.deduplicated(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label))


def test_links_a_leader_does_not_show_are_found(spark, texts):
    """With leaders of no use, comparing texts that share a rare run finds the same classes."""
    different = sorted({t for t in texts if t})
    frame = spark.createDataFrame([(t,) for t in different], "text string").select(near.text_key().alias("key"), "text")
    apart = frame.select("key", near.F.col("key").alias("class"))
    pairs = near._sharing_rare(frame, apart, 0.8)
    linked = near._verified(pairs, frame, 0.8).join(frame.withColumnRenamed("key", "a").withColumnRenamed("text", "x"), "a")
    linked = linked.join(frame.withColumnRenamed("key", "b").withColumnRenamed("text", "y"), "b")
    got = {tuple(sorted((r.x, r.y))) for r in linked.collect()}
    held = {t: shingles(t) for t in different}
    assert got == {(a, b) for i, a in enumerate(different) for b in different[i + 1 :] if held[a] and held[b] and similarity(held[a], held[b]) >= 0.8}


def test_a_cluster_with_one_outsider_is_not_joined_with_itself(spark):
    rows = [(f"r{i % 7}", f"k{i // 7}", "cluster") for i in range(7 * 500)] + [("r0", "outsider", "other"), ("r1", "outsider", "other")]
    rare = spark.createDataFrame(rows, "unit string, a string, class string")
    left = near._outsiders(rare)
    assert sorted(map(tuple, left.select("unit", "a", "class").collect())) == [("r0", "outsider", "other"), ("r1", "outsider", "other")]
    assert left.join(rare.toDF("unit", "b", "b_class"), "unit").count() == 2 * 501


def test_coordinates_agree_as_often_as_texts_are_similar():
    a = [f"a{i}" for i in range(80)] + [f"b{i}" for i in range(20)]
    b = [f"a{i}" for i in range(80)] + [f"c{i}" for i in range(20)]
    k = 4000
    row, element, count = near.elements(pa.array([" ".join(a), " ".join(b), "", " ".join(a + a)]), 1)
    darts = near.dart_signatures(row, element, count.astype(float), 4, k)
    assert abs((darts[0] == darts[1]).mean() - 80 / 120) < 0.03
    assert abs((darts[0] == darts[3]).mean() - 0.5) < 0.03  # every word twice: weights 1 and 2
    assert not darts[2].any() and darts[0].all()
    half = near.dart_signatures(row, element, count * 0.5, 4, k)
    assert abs((half[3] == darts[0]).mean() - 1) < 1e-9  # weights need not be whole


def test_repeated_rows_and_missing_ids(spark):
    rows = [(None, "x y z", None, None), (None, "x y z", None, None), (5, "x y z", None, None), (5, "x y z", None, None), (None, "alone here", None, None)]
    found = near.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.doc_id or 0, r.class_id or 0, r.class_size) for r in found.collect()) == [(0, 0, 1), (0, 5, 4), (0, 5, 4), (5, 5, 4), (5, 5, 4)]
    kept = near.deduplicated(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, "alone here"), (5, "x y z")]


def test_empty(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert near.near_duplicates(frame).count() == 0 and near.deduplicated(frame).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (200, 199), (199, 200)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)} | {199: 199, 200: 199}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similarity_of_short_and_wordless_texts():
    value = near.similarities(pa.array(["a b", "", "a b c d e f", "x x x x x x x"]), pa.array(["A B", "", "a b c d e g", "x x x x x"]))
    assert np.allclose(value, [1, 0, 1 / 3, 1 / 3])
