from __future__ import annotations

import os
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import repeats
from martloom.llm.suffixes import SHALLOW, common, ordered

SCHEMA = "doc_id long, text string, kept string"


def check_order(strings: list[bytes]) -> None:
    order, shared = ordered(strings)
    assert sorted(order) == list(range(len(strings)))
    assert [strings[i] for i in order] == sorted(strings)
    pairs = zip(order, order[1:])
    assert shared[1:] == [len(os.path.commonprefix([strings[a], strings[b]])) for a, b in pairs]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([b"", b"x" * SHALLOW, b"x" * 300]), st.binary(max_size=12)), min_size=1, max_size=30))
def test_sorted_by_quicksort_above_and_tries_below(parts):
    check_order([a + b for a, b in parts])


def test_sorting_repeats_prefixes_and_nothing():
    base = bytes(range(256)) * 2
    check_order([base[:n] for n in range(0, 500, 7)] * 3)
    assert ordered([]) == ([], [0])
    assert common(b"abc", b"abd") == 2 and common(b"", b"a") == 0


def brute(texts: list, length: int) -> list[tuple[int, int, int, bytes]]:
    held, seen = [(t or "").encode() for t in texts], Counter()
    for b in held:
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    found = []
    for b in held:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        found.append((len(b), sum(gone), runs, bytes(x for x, y in zip(b, gone) if not y)))
    return found


@pytest.fixture(scope="module")
def texts() -> list:
    random.seed(3)
    noise = lambda n: "".join(random.choice("abcdefgh é\n") for _ in range(n))
    passages = [noise(n) for n in (90, 97, 130, 300, 500)]
    rows: list = [None, "", noise(50), "ab" * 60_000, noise(1000), "The " * 200, "x" * 333]
    for _ in range(60):
        pieces = [
            random.choice([noise(random.randrange(1, 150)), random.choice(passages), random.choice(passages)[random.randrange(40) :], "ab" * random.randrange(80)])
            for _ in range(random.randrange(1, 6))
        ]
        rows.append("".join(pieces))
    return rows + [rows[12], rows[12]]


@pytest.mark.parametrize("limit", [20_000, 1])
def test_as_brute_force_gathered_or_counted(spark, texts, limit):
    texts = [t if t is None or len(t) < 10_000 else t[:4000] for t in texts]
    frame = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], SCHEMA)
    found = repeats.without_repeats(frame, 96, limit)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()}
    assert got == dict(enumerate(brute(texts, 96)))


def test_a_long_text_repeats_itself(spark):
    frame = spark.createDataFrame([(None, "ab" * 150_000, None), (1, "short", None)], SCHEMA)
    found = {r.doc_id: (r.n_removed, r.n_spans) for r in repeats.without_repeats(frame).collect()}
    assert found == {None: (300_000, 1), 1: (0, 0)}


def test_empty_and_too_short_a_length(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert repeats.without_repeats(frame).count() == 0
    with pytest.raises(ValueError):
        repeats.without_repeats(frame, 60)
