"""Further columns of the input, whatever they are called, stay as they are."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martloom.llm import decontaminate, divergence, fim, language, lm, mixing, near, private, quality, repeats

#: Every name an operator gives to a column of its own while it works, and some in other case.
WORKING = "n times i unit size copies_ key low best _key _low _unit _n _times _i _entities _row _surrogates _named _flag _train train TRAIN_ flag block docs words part place term rank rows e kind value surrogate grams digest first second form_".split()
TEXTS = ["call Anna Lopez at 97.51.17.173 or +1 (017) 555-7713", "a plain text of some words here", None, "", "a plain text of some words here", "the sky is blue and the sea is deep"]


def frame(spark):
    rows = [(i, t, "en", f"s{i % 2}", *(f"{name}{i}" for name in WORKING)) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {', '.join(f'`{x}` string' for x in WORKING)}")


def operators(docs, spark):
    benchmark = spark.createDataFrame([(1, "the sky is blue and the sea is deep")], "item_id long, text string")
    return {
        "mix": lambda: mixing.mix(docs),
        "pseudonymised": lambda: private.pseudonymised(docs),
        "scored": lambda: lm.scored(docs, F.col("doc_id") > 0),
        "deduplicated": lambda: near.deduplicated(docs),
        "clean": lambda: decontaminate.clean(docs, benchmark),
        "contaminated": lambda: decontaminate.contaminated(docs, benchmark),
        "without_repeats": lambda: repeats.without_repeats(docs),
        "quality": lambda: quality.scored(docs, quality.learn(quality.features(_texts()), quality.features(_texts()), 0.5, steps=5)),
        "identify": lambda: language.identify(docs, language.fit(docs)),
        "filled_in_middle": lambda: fim.filled_in_middle(docs),
    }


def _texts():
    return pa.array([t or "" for t in TEXTS])


@pytest.mark.parametrize("name", ["mix", "pseudonymised", "scored", "deduplicated", "clean", "contaminated", "without_repeats", "quality", "identify", "filled_in_middle"])
def test_all_further_columns_stay(spark, name):
    docs = frame(spark)
    found = operators(docs, spark)[name]().collect()
    assert found
    replaced = {"without_repeats": set(), "filled_in_middle": {"n"}}.get(name, set())
    for row in found:
        values = row.asDict()
        for column in set(WORKING) - replaced:
            assert values[column] == f"{column}{row.doc_id}", (name, column)


def test_divergence_takes_no_further_column(spark):
    assert divergence.divergence(frame(spark), least_docs=1).count() > 0
