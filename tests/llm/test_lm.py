from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martloom.llm import lm

SCHEMA = "doc_id long, text string, learn boolean, score string"


def tokens(text: str | None) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]


class Brute:
    """The same model with plain dictionaries."""

    def __init__(self, texts: list):
        self.c, self.pairs, self.begun = Counter(), Counter(), Counter()
        for text in texts:
            h = " "
            for w in tokens(text):
                self.c[w] += 1
                self.pairs[h, w] += 1
                self.begun[h] += 1
                h = w
        self.n = sum(self.c.values())
        self.d1, self.unknown = lm.unigram_model(self.n, Counter(self.c.values()))
        self.d2 = lm.good_turing(Counter(self.pairs.values()), lm.CUT)
        mass, single = Counter(), Counter()
        for (h, w), c in self.pairs.items():
            if c >= lm.CUT:
                mass[h] += self.discounted(c, self.d2)
                single[h] += self.one(w)
        self.scale, self.alpha = {}, {}
        for h, n in self.begun.items():
            share = mass[h] / n
            self.scale[h] = min(1, n / (n + 1) / share) if share else 1
            self.alpha[h] = (1 - self.scale[h] * share) / (1 - single[h])

    @staticmethod
    def discounted(c: int, d: list[float]) -> float:
        return c * (d[c - 1] if c <= lm.KEEP else d[lm.KEEP] if len(d) > lm.KEEP else 1.0)

    def one(self, w: str) -> float:
        return self.discounted(self.c[w], self.d1) / self.n if w in self.c else self.unknown

    def two(self, h: str, w: str) -> float:
        c = self.pairs.get((h, w), 0)
        if c >= lm.CUT:
            return self.scale[h] * self.discounted(c, self.d2) / self.begun[h]
        return self.alpha.get(h, 1.0) * self.one(w)

    def score(self, text: str | None) -> tuple:
        h, value, base, known = " ", 0.0, 0.0, 0
        for w in tokens(text):
            value += math.log10(self.two(h, w))
            base += math.log10((self.c[w] + 1) / (self.n + len(self.c) + 1))
            known += w in self.c
            h = w
        return len(tokens(text)), known, self.n, pytest.approx(base), pytest.approx(value)


@pytest.fixture(scope="module")
def rows() -> list:
    random.seed(6)
    words = ["the", "The", "of", *(f"w{i}" for i in range(60)), "é", "É", "a b"]
    weights = [30, 10, 10] + [1] * 63
    made = [(i, " \t".join(random.choices(words, weights, k=random.randrange(80))), i % 5 != 0, "x") for i in range(200)]
    made += [(None, None, True, None), (1, "", True, None), (2, "unheard of", None, None), (2, "unheard of", False, None)]
    return made + [(7, "same " * 100_000, True, None), (8, "rare1 rare2 rare1 rare2", True, None)]


def scores(spark, rows: list) -> list[tuple]:
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = lm.scored(frame, F.col("learn"))
    assert found.columns == ["doc_id", "learn", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return sorted(found.collect(), key=lambda r: (r.doc_id or 0, r.n_tokens, r.learn or False))


@pytest.mark.parametrize("small", [False, True])
def test_as_with_plain_dictionaries(spark, rows, monkeypatch, small):
    if small:  # many blocks and parts, frequent words dealt among several; set where the driver plans
        monkeypatch.setattr(lm, "PART", 500)
        monkeypatch.setattr(lm, "HOT", 1e-4)
    model = Brute([t for _, t, learn, _ in rows if learn])
    wanted = [model.score(t) for t in (r[1] for r in sorted(rows, key=lambda r: (r[0] or 0, len(tokens(r[1])), r[2] or False)))]
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in scores(spark, rows)] == wanted


def test_probabilities_of_every_history_add_up_to_one(rows):
    model = Brute([t for _, t, learn, _ in rows if learn])
    for h in [*model.begun, "never"]:
        assert sum(model.two(h, w) for w in model.c) + model.alpha.get(h, 1.0) * model.unknown == pytest.approx(1)


def test_discounts():
    assert lm.good_turing({}) == [1.0] * 5
    assert lm.good_turing({1: 100, 2: 40, 3: 20, 4: 12, 5: 8, 6: 5})[0] == pytest.approx((0.8 - 0.3) / 0.7)
    assert lm.unigram_model(0, {}) == ([0.0] * 6, 1.0)
    factors, left = lm.unigram_model(10, {5: 2})
    assert sum(f * 5 * 2 for f in factors[4:5]) / 10 + left == pytest.approx(1)


def test_nothing_to_learn_from_and_nothing_at_all(spark):
    found = scores(spark, [(1, "a b", False, None)])
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found] == [(3, 0, 0, 0.0, 0.0)]
    assert scores(spark, []) == []


class Whole(Brute):
    """All bigrams of training count, those seen once too; says so by itself, whatever the module's CUT."""

    def __init__(self, texts: list):
        super().__init__(texts)
        self.d2 = lm.good_turing(Counter(self.pairs.values()))
        mass, single = Counter(), Counter()
        for (h, w), c in self.pairs.items():
            mass[h] += self.discounted(c, self.d2)
            single[h] += self.one(w)
        for h, n in self.begun.items():
            share = mass[h] / n
            self.scale[h] = min(1, n / (n + 1) / share)
            self.alpha[h] = (1 - self.scale[h] * share) / (1 - single[h])

    def two(self, h: str, w: str) -> float:
        if c := self.pairs.get((h, w), 0):
            return self.scale[h] * self.discounted(c, self.d2) / self.begun[h]
        return self.alpha.get(h, 1.0) * self.one(w)


@pytest.mark.parametrize("small", [False, True])
def test_bigrams_seen_once_have_their_own_discount(spark, rows, monkeypatch, small):
    if small:
        monkeypatch.setattr(lm, "PART", 500)
        monkeypatch.setattr(lm, "HOT", 1e-4)
    random.seed(7)
    more = rows + [(i, " ".join(random.choices([f"v{n}" for n in range(40)], range(1, 41), k=30)), i % 3 != 0, "x") for i in range(300, 340)]
    model = Whole([t for _, t, learn, _ in more if learn])
    assert 0 < model.d2[0] < 1 and Counter(model.pairs.values())[1] > 100
    wanted = [model.score(r[1]) for r in sorted(more, key=lambda r: (r[0] or 0, len(tokens(r[1])), r[2] or False))]
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in scores(spark, more)] == wanted


@pytest.mark.parametrize("small", [False, True])
def test_a_stored_model_scores_texts_it_was_not_fitted_to(spark, rows, monkeypatch, tmp_path, small):
    if small:
        monkeypatch.setattr(lm, "PART", 500)
        monkeypatch.setattr(lm, "HOT", 1e-4)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    lm.learn(frame.filter("learn").select("text"), f"{tmp_path}/model")
    stored = lm.Stored(spark, f"{tmp_path}/model")
    model = Whole([t for _, t, learn, _ in rows if learn])
    assert stored.bigrams.count() == len(model.pairs)
    held = stored.bigrams.groupBy("h").agg(F.sum("p").alias("seen"))
    assert held.filter("seen >= 1").count() == 0  # every history leaves something to what it was not seen with
    asked = [r for r in rows if not r[2]] + [(900, "w1 w2 never the of", None, "x"), (901, None, None, "x"), (902, "w3 " * 50_000, None, "x")]
    found = stored.scored(spark.createDataFrame(asked, SCHEMA.replace("learn", "Train")).repartition(2))
    assert found.columns == ["doc_id", "Train", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    wanted = {r[0]: model.score(r[1]) for r in asked}
    got = found.collect()
    assert len(got) == len(asked)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == wanted[r.doc_id]
    assert stored.scored(frame.limit(0)).count() == 0
    alone = spark.createDataFrame([("w1 w2",), (None,)], "text string")
    one, two = sorted(stored.scored(alone).collect(), key=lambda r: r.n_tokens)
    assert one.asDict().keys() == {"n_tokens", "n_known", "train_tokens", "base_score", "score"}
    assert tuple(one) == model.score(None) and tuple(two) == model.score("w1 w2")
    assert sorted(r.n_tokens for r in lm.scored(alone, F.lit(True)).collect()) == [1, 3]


def test_a_stored_model_of_nothing(spark, tmp_path):
    lm.learn(spark.createDataFrame([], SCHEMA), f"{tmp_path}/model")
    found = lm.Stored(spark, f"{tmp_path}/model").scored(spark.createDataFrame([(1, "a b", None, None)], SCHEMA))
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.score) for r in found.collect()] == [(3, 0, 0, 0.0)]
