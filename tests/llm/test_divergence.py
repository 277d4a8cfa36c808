from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from martloom.llm.divergence import _share, divergence, document_terms, kept_counts
from martloom.llm.scratch import stored

SCHEMA = "text string, lang string, source string, part string, place string, term string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text: str | None) -> list[str]:
    return [x.translate(LOWER) for x in TERM.findall(text or "")]


def brute(rows: list[tuple], least: int, top: int) -> set[tuple]:
    docs, used, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        docs[lang].update(set(terms_of(text)))
        used[lang, source].update(terms_of(text))
    kept = {lang: {t for t, n in found.items() if n >= least} for lang, found in docs.items()}
    share, whole = {}, {}
    for lang, terms in kept.items():
        sources = [s for x, s in groups if x == lang]
        for s in [*sources, None]:
            count = {t: sum(used[lang, x][t] for x in (sources if s is None else [s])) for t in terms}
            total = sum(count.values()) + 2 * len(terms)
            share[lang, s] = {t: 1 + 10**9 * (n + 2) // total for t, n in count.items()}
            whole[lang, s] = count

    def apart(p: int, q: int) -> int:
        return (p - q) * (p - q) // (p + q)

    out = set()
    for lang, source in groups:
        own, count, all_ = share[lang, source], whole[lang, source], share[lang, None]
        pairs = [(s, sum(apart(own[t], share[lang, s][t]) for t in kept[lang])) for x, s in groups if x == lang and s != source]
        of_terms = [(t, apart(own[t], all_[t])) for t in kept[lang] if count[t] > 0 and own[t] > all_[t]]
        for part, items, most in (("pair", pairs, None), ("term", of_terms, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out |= {(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1)}
    return out


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    random.seed(4)
    vocabulary = [random.choice("abcXYZéß日😀") * random.randrange(1, 4) + random.choice(["", "ing", "ung", "ción" * 9]) + str(random.choice(["", 7])) + random.choice("abcd") * random.randrange(3) for _ in range(120)]
    vocabulary += ["q" * 300, "q" * 300 + "r", "prefix", "prefixes", "pre"]
    out = [(None, "en", "s1"), ("", None, None), ("", "xx", "only here"), ("12 34 []", "yy", None), ("12", "yy", "z")]
    for i in range(260):
        lang, source = random.choice([("en", "s1"), ("en", "s2"), ("en", ""), ("en", None), ("de", "s1"), (None, "s9"), ("de", f"t{i % 7}")])
        words = random.choices(vocabulary, k=random.randrange(0, 60))
        out.append((random.choice([" ", "\n", "1", "_"]).join(words).title() if i % 9 else "Rare%d same" % i, lang, source))
    return out + [("the same row, twice", "en", "s2")] * 12 + [("word " * 40_000, "en", "s2")]


@pytest.mark.parametrize("options", [{}, {"block": 2, "part": 7, "first": 1}, {"most_bits": 1 << 15, "first": 7}])
def test_as_brute_force(spark, rows, options):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(5)
    found = divergence(frame, least_docs=4, top=6, **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in found.collect()} == brute(rows, 4, 6)


def test_prefixes_of_rare_terms_are_discarded(spark, rows):
    """Only terms in enough documents remain, whatever they begin with, also with a table full of wrong bits."""
    terms = stored(document_terms(spark.createDataFrame([r for r in rows], "text string, lang string, source string")), "test-terms")
    docs = defaultdict(Counter)
    for text, lang, _ in rows:
        docs[lang or ""].update(set(terms_of(text)))
    for bits in (1 << 15, 1 << 20):
        kept = kept_counts(terms, 4, most_bits=bits).select("lang", F.col("term").cast("string")).distinct()
        assert {tuple(r) for r in kept.collect()} == {(x, t) for x, found in docs.items() for t, n in found.items() if n >= 4}


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, kept = 3 * 10**17 + 1, 9 * 10**18, 10**9 + 7
    row = spark.createDataFrame([(n, total, kept)], "n long, total long, kept long").select(_share(F.col("n"), F.col("total"), F.col("kept")).alias("p"))
    assert row.first().p == 1 + 10**9 * (n + 2) // (total + 2 * kept)


def test_empty_table(spark):
    assert divergence(spark.createDataFrame([], SCHEMA)).count() == 0
