from __future__ import annotations

import zlib

import pytest

from martloom.llm import language
from martloom.llm.sample import bounded
from martloom.llm.queries import op2_language

SCHEMA = "doc_id long, text string, lang string, score string, lang_pred string"
ROWS = [
    (1, "the house and the garden", "en", None, None),
    (2, "the old house of the king", "en", "x", "y"),
    (3, "das haus und der garten", "de", None, None),
    (4, "das alte haus des königs", "de", None, None),
    (5, None, "de", None, None),
    (6, "no language", None, None, None),
    (1, "the house and the garden", "en", None, None),
]


def predicted(spark, texts: list) -> list[tuple]:
    model = language.fit(spark.createDataFrame(ROWS, SCHEMA))
    docs = spark.createDataFrame([(i, t, None, "old", "old") for i, t in enumerate(texts)], SCHEMA)
    return [(r.lang_pred, round(r.score, 3)) for r in language.identify(docs, model).orderBy("doc_id").collect()]


def test_words_then_shorter_pieces_then_nothing(spark):
    got = predicted(spark, ["The GARDEN", "der", "königshaus", "kinghouse", "", None, "12 !? 3", "漢字", "the house " * 200_000])
    assert [lang for lang, _ in got] == ["en", "de", "de", "en", "und", "und", "und", "de", "en"]
    assert all(score == 0 for lang, score in got if lang == "und")
    assert got[7][1] == 0.5  # nothing known: all alike, the first language


def test_backs_off_to_the_longest_known_length():
    model = language.Model(["a", "b"], {}, {1: {"x": (1.0, 2.0)}, 2: {"xy": (3.0, 1.0), "yx": (1.0, 1.0)}})
    scorer = language.Scorer(model)
    assert scorer.cost("xyx") == (2.0, 1.0)
    assert scorer.cost("zx") == (1.0, 2.0)
    assert scorer.cost("q") == scorer.none


def test_nothing_to_learn_from(spark):
    model = language.fit(spark.createDataFrame([], SCHEMA))
    docs = spark.createDataFrame([(1, "words", None, None, None)], SCHEMA)
    assert [(r.lang_pred, r.score) for r in language.identify(docs, model).collect()] == [("und", 0.0)]


@pytest.mark.parametrize("common", [300, 30_000])
def test_a_rare_language_is_learned_at_every_size(spark, common):
    rows = spark.range(common).selectExpr("id AS doc_id", "concat('the word ', id, ' of many') AS text", "'en' AS lang")
    copies = spark.range(common).selectExpr("id + 1000000 AS doc_id", "'the same text again' AS text", "'en' AS lang")
    rare = spark.range(30).selectExpr("-id - 1 AS doc_id", "concat('das seltene wort ', id) AS text", "'de' AS lang")
    model = language.fit(rows.union(copies).union(rare), fit_rows=200)
    assert model.languages == ["de", "en"]
    assert language.Scorer(model).predict("das wort")[0] == "de" and language.Scorer(model).predict("the many")[0] == "en"
    assert model.words["seltene"][0] == model.words["das"][0]  # all of its thirty texts


def test_the_sample_counts_repeats_once_and_follows_the_values(spark):
    rows = spark.range(40_000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('t', id) END AS text", "CASE WHEN id < 100 THEN NULL ELSE 'x' END AS _hash")
    drawn = bounded(rows, 1_000, "text").collect()
    assert 850 < len(drawn) < 1_150 and len({r.text for r in drawn}) == len(drawn)
    again = bounded(rows.repartition(7), 1_000, "text").collect()
    assert {r.text for r in drawn} == {r.text for r in again}
    each = bounded(rows, 500, "text", each="_hash").collect()
    assert sum(r._hash is None for r in each) == 51 and 400 < sum(r._hash == "x" for r in each) < 600
    assert 15 < sum(r._hash is None for r in bounded(rows, 30, "text", each="_hash").collect()) < 46
    assert bounded(rows, 10, "text", each="_hash").columns == ["id", "text", "_hash"]
    with pytest.raises(ValueError, match="text has more than"):
        bounded(rows, 10, "text", each="text")


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op2_language(spark, folder).collect()
    assert {r.doc_id for r in rows if r.held_out} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
