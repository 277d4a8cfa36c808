"""The stages over the sample, each held against what it must keep and what must go."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tests.llm.test_decontaminate import brute as matches
from tests.llm.test_near import brute as classes

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(corpus_pipeline.stored(stage(spark, found[-1], FOLDER), "test"))
    return found


def test_stages_in_order(kept):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "near-duplicate removal", "benchmark decontamination", "surrogates for personal data", "source mixing",
    ]
    assert all(df.columns == kept[0].columns for df in kept[:-1])
    assert kept[-1].columns == [*kept[0].columns, "copies"]


def test_quality_keeps_the_good(spark, kept):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good = labels.filter("quality = 1").join(kept[0], "doc_id", "left_semi")
    assert good.join(kept[1], "doc_id", "left_semi").count() >= 0.97 * good.count()


def test_one_of_each_class_and_no_benchmark_item(spark, kept):
    rows = sorted((r.doc_id, r.text) for r in kept[1].collect())
    label = classes([t for _, t in rows])
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted(rows[i][0] for i in set(label))
    before = [(r.doc_id, r.text) for r in kept[2].collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    dirty = {i for i, _, _ in matches([x for x in before if len(x[1]) < 8000], items)}
    assert {r.doc_id for r in kept[3].collect()} & dirty == set()
    assert len(before) - kept[3].count() >= len(dirty)


def test_personal_data_is_replaced_and_clean_texts_stay(kept):
    before, after = ({r.doc_id: r for r in df.collect()} for df in kept[3:5])
    assert set(before) == set(after)
    pattern = re.compile(r"\S+@\S+\.com|\b\d{16}\b|\+1 \(\d{3}\) \d{3}-\d{4}")
    real = {x for r in before.values() for x in pattern.findall(r.text)}
    assert real and not any(x in r.text for r in after.values() for x in real)
    for i, r in after.items():
        assert r.n_chars == len(r.text) if r.text != before[i].text else r == before[i]


def test_the_mix_is_made_of_what_was_kept(kept):
    left = {r.doc_id for r in kept[4].collect()}
    rows = kept[5].collect()
    assert {r.doc_id for r in rows} <= left and all(1 <= r.copies <= 3 for r in rows)


def test_registered_and_run_as_a_whole(spark):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_every_operator_is_registered():
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 11))
