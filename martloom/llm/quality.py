"""Quality scores by positive-unlabelled learning: trusted good texts, unlabelled web text, no bad ones.

Texts become a vector: shares and logarithms of their shape (letters, capitals, symbols, repeats, line and
word shapes), and how much of them falls into each of ``BUCKETS`` buckets of hashed words and word pairs.
With class prior pi, the risk of a scorer g is

    pi * E_pos[loss(g)] + max(0, E_unl[loss(-g)] - pi * E_pos[loss(-g)])

whose second part estimates the risk on the bad texts nobody labelled and is kept from turning
negative (Kiryo et al., 2017).  Scorers are fitted on bounded samples.  The prior is a figure of the
corpus and is estimated over every unlabelled text: under any score, unlabelled text above a threshold is at
least pi times the positive text above it, so the texts are scored by a model that learned from other ones and
counted by score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.arrow import Words, mix64, utf8, words
from martloom.llm.sample import bounded
from martloom.llm.scratch import prepare, widened

#: Kinds of bytes whose shares are features.
KINDS = {
    "upper": range(0x41, 0x5B),
    "lower": range(0x61, 0x7B),
    "digit": range(0x30, 0x3A),
    "space": (0x20, 0x09),
    "line": (0x0A,),
    "stop": b".,;:?",
    "shout": b"!",
    "symbol": b"#$%&*+<=>@\\^_`{}~",
    "bar": b"|",
    "quote": b"\"'()-/[]",
    "other": range(0x80, 0x100),
}
_KIND = np.full(256, len(KINDS), np.uint8)
for _i, _bytes in enumerate(KINDS.values()):
    _KIND[list(_bytes)] = _i
_ODD = np.array([k in ("digit", "shout", "symbol", "bar") for k in (*KINDS, "")])
SHAPES = (*KINDS, "chars", "words", "word_length", "distinct", "commonest", "same_as_last", "odd_words", "lines", "distinct_lines", "line_words")
#: Buckets of hashed words, and as many of pairs of neighbouring words.
BUCKETS = 128
FEATURES = (*SHAPES, *(f"word_{i}" for i in range(BUCKETS)), *(f"pair_{i}" for i in range(BUCKETS)))
#: Words of a text whose word features count half.
ENOUGH = 100
#: Scores are counted between this many thresholds when the prior is estimated.
CUTS = 96


def features(texts: pa.Array) -> np.ndarray:
    """One line for each text, from all of it; a null or empty text gives zeros."""
    data, at = utf8(texts)
    size = np.diff(at)
    kind = _KIND[data]
    place = np.repeat(np.arange(len(size)) * (len(KINDS) + 1), size) + kind
    held = np.bincount(place, minlength=len(size) * (len(KINDS) + 1)).reshape(len(size), -1)
    shares = held[:, :-1].T / np.maximum(size, 1)
    found = words(texts)
    n = np.diff(found.first)
    rows = len(n)
    per = np.maximum(n, 1)
    order = np.lexsort((found.hash, found.row))
    h, r = found.hash[order], found.row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    distinct = np.bincount(r[new], minlength=rows)
    most = np.zeros(rows)
    if len(h):
        np.maximum.at(most, r[new], np.diff(np.append(np.flatnonzero(new), len(h))))
    same = np.zeros(len(found.hash), bool)
    same[1:] = (found.hash[1:] == found.hash[:-1]) & (found.row[1:] == found.row[:-1])
    odd = np.concatenate([[0], np.cumsum(_ODD[kind])])
    odd_words = np.bincount(found.row, odd[found.end] > odd[found.start], minlength=rows) if len(found.row) else np.zeros(rows)
    letters = np.bincount(found.row, found.end - found.start, minlength=rows) if len(found.row) else np.zeros(rows)
    lines = np.array([_lines(x) for x in pc.fill_null(texts, "").to_pylist()], float).reshape(rows, 2)
    return np.column_stack(
        [
            *shares,
            np.log1p(size) / 10,
            np.log1p(n) / 10,
            np.minimum(letters / per, 30) / 10,
            distinct / per,
            most / per,
            np.bincount(found.row, same, minlength=rows) / per if len(found.row) else np.zeros(rows),
            odd_words / per,
            np.log1p(lines[:, 0]) / 10,
            lines[:, 1] / np.maximum(lines[:, 0], 1),
            np.log1p(n / np.maximum(lines[:, 0], 1)) / 10,
            *_buckets(found).T,
        ]
    )


def _buckets(found: Words) -> np.ndarray:
    """The root of each bucket's share of a text's words, then of its word pairs."""
    rows, h = len(found.first) - 1, found.hash
    inside = found.row[1:] == found.row[:-1]
    pair = mix64(h[:-1] * np.uint64(3) + h[1:])[inside]
    shares = []
    for hashed, row in ((h, found.row), (pair, found.row[1:][inside])):
        bucket = (hashed % np.uint64(BUCKETS)).astype(np.int64)
        held = np.bincount(row * BUCKETS + bucket, minlength=rows * BUCKETS).reshape(rows, BUCKETS)
        shares.append(np.sqrt(held / np.maximum(held.sum(1, keepdims=True), 1)))
    return np.column_stack(shares)


def _lines(text: str) -> tuple[int, int]:
    lines = [x for x in text.split("\n") if x]
    return len(lines), len(set(lines))


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return _logistic(_expanded(x, self.mean, self.spread) @ self.weights)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _expanded(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """A constant, each feature against the average text, and the square of each that tells a shape.

    The words of a short text tell little of what it could have said: their features count the less, the
    fewer words there are.
    """
    z = np.clip((x - mean) / spread, -8, 8)
    n = np.expm1(10 * x[:, SHAPES.index("words")])
    shape, said = z[:, : len(SHAPES)], z[:, len(SHAPES) :] * (n / (n + ENOUGH))[:, None]
    return np.column_stack([np.ones(len(z)), shape, shape * shape / 8, said])


_SIZE = 1 + len(SHAPES) + len(FEATURES)


def _descend(gradient, size: int, steps: int, rate: float = 0.05) -> np.ndarray:
    """Adam from zero."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _shrink(positives: int, least: float = 0.02) -> np.ndarray:
    """How strongly each weight is drawn to zero: words the more, the fewer texts there are to judge them by."""
    held = np.full(_SIZE, least)
    held[1 + 2 * len(SHAPES) :] = max(least, 200 / max(positives, 1))
    return held


def _scaling(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return both.mean(0), np.maximum(both.std(0), 1e-3)


def separate(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 300) -> Model:
    """A scorer that tells positive from unlabelled text, for the prior; without either, the constant 0.5."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(_SIZE), 0.5)
    mean, spread = _scaling(np.concatenate([positive, unlabelled]))
    p, u = (_expanded(x, mean, spread) for x in (positive, unlabelled))
    shrink = _shrink(len(p))
    w = _descend(lambda w: (p.T @ -_logistic(-p @ w)) / len(p) + (u.T @ _logistic(u @ w)) / len(u) + shrink * w, _SIZE, steps)
    return Model(mean, spread, w, 0.5)


def thresholds(positive: np.ndarray) -> np.ndarray:
    """Scores that cut the positive texts into parts of about one size."""
    return np.unique(np.quantile(positive, np.linspace(0, 0.95, CUTS)))


def estimate_prior(above_p: np.ndarray, above_u: np.ndarray, n_p: int, n_u: int) -> float:
    """The least ratio of unlabelled to positive text above any threshold, each share with its sampling error."""
    error = np.sqrt(np.log(40) / 2)  # of a share, with probability 0.95, times sqrt(n)
    most = (above_u + error / np.sqrt(n_u)) / np.maximum(above_p - error / np.sqrt(n_p), 1e-3)
    best = int(most.argmin())
    return float(np.clip(above_u[best] / max(above_p[best], 1e-3), 0.01, 0.99))


def learn(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400) -> Model:
    """A scorer of least non-negative risk; with no positive or no unlabelled text, the constant 0.5."""
    if not len(positive) or not len(unlabelled):
        return separate(positive, unlabelled)
    mean, spread = _scaling(np.concatenate([positive, unlabelled]))
    p, u = (_expanded(x, mean, spread) for x in (positive, unlabelled))
    shrink = _shrink(len(p))

    def risk(w: np.ndarray) -> np.ndarray:
        on_p, on_u = p @ w, u @ w
        good = prior * (p.T @ -_logistic(-on_p)) / len(p)
        bad = (u.T @ _logistic(on_u)) / len(u) - prior * (p.T @ _logistic(on_p)) / len(p)
        value = np.logaddexp(0, on_u).mean() - prior * np.logaddexp(0, on_p).mean()
        return (good + bad if value >= 0 else -bad) + shrink * w  # below zero, step back out

    return Model(mean, spread, _descend(risk, _SIZE, steps), prior)


def fit(texts: DataFrame, labels: DataFrame, fit_rows: int = 10_000) -> Model:
    """Learn from ``texts`` (doc_id, text) and ``labels`` (doc_id, quality).

    Positive: documents all of whose labels are 1.  Unlabelled: documents without a label; where there
    are none, all documents.  About ``fit_rows`` different ones of each are learned from, in whole; only
    their feature vectors reach the driver.  The class prior is estimated over all unlabelled documents: each
    text is in one of two folds by a hash of it, and is scored by the model of the other one.
    """
    prepare(texts.sparkSession)
    marked = labels.groupBy("doc_id").agg(F.min("quality").alias("mark")).filter("mark IS NOT NULL")
    told = F.xxhash64("text")
    rows = texts.select("doc_id", "text", told.alias("told"), F.xxhash64(told, F.lit("fold")).bitwiseAND(F.lit(1)).cast("int").alias("fold"))
    keys = rows.select("doc_id", "told")  # joined without their texts, which are not shuffled
    good = keys.join(marked.filter("mark = 1"), "doc_id", "left_semi")
    (p, p_fold), (u, u_fold) = _sampled(rows, fit_rows, good, keys.join(marked, "doc_id", "left_anti"))
    if not len(u):
        marked = marked.limit(0)
        (p, p_fold), (u, u_fold) = _sampled(rows, fit_rows, good, keys)
    return learn(p, u, _prior(p, p_fold, u, u_fold, rows, marked))


def _prior(p: np.ndarray, p_fold: np.ndarray, u: np.ndarray, u_fold: np.ndarray, rows: DataFrame, labelled: DataFrame) -> float:
    """The prior among all of ``rows`` that are not ``labelled``; 0.5 if there is too little to tell."""
    if not all((x == i).any() for x in (p_fold, u_fold) for i in (0, 1)):
        return 0.5
    models = [separate(p[p_fold != i], u[u_fold != i]) for i in (0, 1)]  # of a fold: what the other one taught
    scores = [models[i].score(p[p_fold == i]) for i in (0, 1)]
    cuts = [thresholds(x) for x in scores]
    counted = _histogram(rows, labelled, models, cuts)
    found = []
    for i in (0, 1):
        n = counted[i].sum()
        if n:
            above_u = counted[i][::-1].cumsum()[::-1][1:] / n
            above_p = np.array([(scores[i] >= c).mean() for c in cuts[i]])
            found.append(estimate_prior(above_p, above_u, len(scores[i]), int(n)))
    return sum(found) / len(found) if found else 0.5


def _histogram(rows: DataFrame, labelled: DataFrame, models: list[Model], cuts: list[np.ndarray]) -> list[np.ndarray]:
    """How many texts of each fold score below the first threshold, from each one to the next, and above the last.

    Every row is scored where it is read; those with a label leave the count by their doc_id alone.
    """
    shared = rows.sparkSession.sparkContext.broadcast((models, cuts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, cuts = shared.value
        for batch in batches:
            x, fold = features(batch.column("text")), batch.column("fold").to_numpy()
            at = np.zeros(len(fold), np.int32)
            for i, model in enumerate(models):
                at[fold == i] = np.searchsorted(cuts[i], model.score(x[fold == i]), "right")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("fold"), pa.array(at)], ["doc_id", "fold", "at"])

    placed = rows.select("doc_id", "text", "fold").mapInArrow(run, widened(rows.select("doc_id", "fold").schema, "at int"))
    total = [np.zeros(len(c) + 1, np.int64) for c in cuts]
    for row in placed.join(labelled, "doc_id", "left_anti").groupBy("fold", "at").agg(F.count("*").alias("n")).collect():
        total[row["fold"]][row["at"]] = row["n"]
    shared.unpersist()
    return total


def _sampled(rows: DataFrame, fit_rows: int, *keys: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and folds of a sample of the rows with each of these keys (doc_id, told).

    The sampled keys, ``fit_rows`` of each, are broadcast to the rows, so only sampled texts leave their task.
    """
    found = []
    for wanted in keys:
        drawn = F.broadcast(bounded(wanted, fit_rows, "doc_id", "told").alias("drawn"))
        same = F.col("drawn.told") == F.col("rows.told")
        same &= F.col("drawn.doc_id").eqNullSafe(F.col("rows.doc_id"))
        found.append(_vectors(rows.alias("rows").join(drawn, same, "left_semi").dropDuplicates(["doc_id", "told"])))
    return found


def _vectors(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features of each text, and its fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column("text")).astype(np.float32)
            vectors = pa.FixedSizeListArray.from_arrays(x.ravel(), len(FEATURES)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([vectors, batch.column("fold")], ["x", "fold"])

    table = rows.select("text", "fold").mapInArrow(run, "x array<float>, fold int").toArrow().combine_chunks()
    x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    order = np.lexsort(x.T)  # the same order whichever task was first
    return x[order], table.column("fold").to_numpy()[order]


def scored(texts: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Adds a score (0 to 1, higher is better) from the whole of ``text`` alone; other columns stay.

    Null and empty texts get the score of a text without any character.  A column of the name added is
    replaced.
    """
    prepare(texts.sparkSession)
    texts = texts.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = pa.array(model.score(features(batch.column("text"))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, said], [*batch.schema.names, name])

    return texts.mapInArrow(run, widened(texts.schema, f"{name} double"))
