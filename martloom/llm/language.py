"""Language identification by words first, backing off to shorter and shorter character n-grams.

A word the model knows costs its negative log frequency in each language; in a language that lacks
it, a fixed penalty.  A word no language knows is cut into n-grams, the longest first: the mean cost
of those that are known at that length counts, and if none is known the next shorter length is tried.
A text goes to the language with the lowest sum over its words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.sample import bounded
from martloom.llm.scratch import prepare, widened

WORD = re.compile(r"[^\W\d_]+")
#: Cost of what a language lacks: as if it occurred once in ten million.
PENALTY = -math.log(1e-7)
#: Remembered costs of unseen words, in each task.
MEMORY = 100_000


@dataclass
class Model:
    languages: list[str]
    #: Costs by language, of words and, by length, of n-grams.
    words: dict[str, tuple[float, ...]]
    grams: dict[int, dict[str, tuple[float, ...]]]


def grams_of(word: str, size: int) -> list[str]:
    framed = f" {word} " if size > 1 else word
    return [framed[i : i + size] for i in range(len(framed) - size + 1)]


def fit(
    texts: DataFrame, fit_rows: int = 5_000, longest: int = 5, words: int = 20_000, grams: int = 6_000
) -> Model:
    """Learn from columns doc_id, text and lang, rows without text or lang aside.

    Of each language about ``fit_rows`` whole texts are learned from, each different text once, so that
    a language is learned alike however small its share of the corpus is.  Of these the ``words`` most
    frequent words and, for each length up to ``longest``, the ``grams`` most frequent n-grams are
    kept (ties by code point).  So the model, which every task gets, has a bounded size.
    """
    prepare(texts.sparkSession)
    rows = bounded(texts.filter("text IS NOT NULL AND lang IS NOT NULL"), fit_rows, "lang", "text", each="lang")
    counted = (
        rows.select("lang", "text")
        .mapInArrow(_counts(longest), "lang string, size int, gram string, n long")
        .groupBy("lang", "size", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram")
    kept = counted.withColumns(
        {"rank": F.row_number().over(order), "total": F.sum("n").over(Window.partitionBy("lang", "size"))}
    ).filter(F.col("rank") <= F.when(F.col("size") == 0, words).otherwise(grams))
    found = kept.select("lang", "size", "gram", (-F.log(F.col("n") / F.col("total"))).alias("cost")).toArrow().to_pydict()
    languages = sorted(set(found["lang"]))
    costs: dict[int, dict[str, list[float]]] = {size: {} for size in range(longest + 1)}
    for lang, size, gram, cost in zip(*(found[c] for c in ("lang", "size", "gram", "cost"))):
        costs[size].setdefault(gram, [PENALTY] * len(languages))[languages.index(lang)] = min(cost, PENALTY)
    tables = {size: {gram: tuple(line) for gram, line in lines.items()} for size, lines in costs.items()}
    return Model(languages, tables.pop(0), tables)


def _counts(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
            for lang, found in seen.items():
                yield _table(lang, 0, found)
                for size in range(1, longest + 1):
                    pieces: Counter = Counter()
                    for word, n in found.items():
                        for gram in grams_of(word, size):
                            pieces[gram] += n
                    yield _table(lang, size, pieces)

    return run


def _table(lang: str, size: int, found: Counter) -> pa.RecordBatch:
    n = len(found)
    return pa.RecordBatch.from_pydict(
        {
            "lang": pa.array([lang] * n, pa.string()),
            "size": pa.array([size] * n, pa.int32()),
            "gram": pa.array(list(found), pa.string()),
            "n": pa.array(list(found.values()), pa.int64()),
        }
    )


class Scorer:
    """Costs of words under a model; remembers those of unseen words."""

    def __init__(self, model: Model):
        self.model = model
        self.none = (PENALTY,) * len(model.languages)
        self.unseen: dict[str, tuple[float, ...]] = {}

    def cost(self, word: str) -> tuple[float, ...]:
        known = self.model.words.get(word)
        if known is None:
            known = self.unseen.get(word)
            if known is None:
                if len(self.unseen) >= MEMORY:
                    self.unseen.clear()
                known = self.unseen[word] = self.back_off(word)
        return known

    def back_off(self, word: str) -> tuple[float, ...]:
        for size in sorted(self.model.grams, reverse=True):
            table = self.model.grams[size]
            found = [table[g] for g in grams_of(word, size) if g in table]
            if found:
                return tuple(sum(x) / len(found) for x in zip(*found))
        return self.none

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its share of the likelihood; ``und`` and 0 for a text without a letter."""
        found = Counter(WORD.findall(text.lower())) if text else None
        if not found or not self.model.languages:
            return "und", 0.0
        costs = np.array([self.cost(w) for w in found])
        total = np.fromiter(found.values(), float, len(found)) @ costs
        best = int(total.argmin())  # the first in code point order, if several are lowest
        return self.model.languages[best], float(1 / np.exp(np.minimum(total[best] - total, 0)).sum())


def identify(texts: DataFrame, model: Model) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1), from the whole of ``text`` alone; other columns stay.

    ``und`` with score 0: the text is null, empty or has no letter, or nothing was learned.  Columns
    of the names added are replaced.
    """
    prepare(texts.sparkSession)
    texts = texts.drop("lang_pred", "score")
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            said = [scorer.predict(x) for x in batch.column("text").to_pylist()]
            columns = [*batch.columns, pa.array([x for x, _ in said], pa.string()), pa.array([x for _, x in said], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lang_pred", "score"])

    return texts.mapInArrow(run, widened(texts.schema, "lang_pred string, score double"))
