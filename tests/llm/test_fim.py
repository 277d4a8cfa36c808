from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martloom.llm.fim import Exceptions, Plan, cuts, filled_in_middle, restored

SCHEMA = "doc_id long, text string, Form string, _first string, output string, _digest string"
TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "a\nb\nc", "é\n日本\n😀x\nend\n", "\r\n\x00\n\u2028 \n", "holds <P> a mark\nx", "ends in <\n<S\n>",
    "ä" * 3000 + "\n" + "z" * 3000, "<M>", "\n".join(f"{i} ü" for i in range(4000)), "tail\n😀", "a\nb\nc",
]


def drawn(plan: Plan, doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(f"{plan.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def brute(plan: Plan, doc_id: int | None, text: str | None) -> tuple:
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if plan.unit == "line" else list(text)
    h, n = drawn(plan, doc_id), len(units)
    if not text or any(m in text for m in plan.marks) or h[2] % 100 >= plan.rate:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    a, b, c = plan.marks
    if h[3] % 100 < plan.spm:
        return n, "spm", len(p), len(m), b + s + a + p + c + m
    return n, "psm", len(p), len(m), a + p + b + s + c + m


@pytest.mark.parametrize("plan", [Plan(), Plan(unit="character"), Plan("x", 40, 100, "line", "<|pre|>", "<|suf|>", "<|mid|>")])
def test_as_brute_force_and_round_trip(spark, plan):
    rows = [(i, t, "old", "f", "o", "d") for i, t in enumerate(TEXTS * 4)] + [(None, "no\nid", None, None, None, None)] * 2
    found = filled_in_middle(spark.createDataFrame(rows, SCHEMA), plan)
    assert found.columns == ["doc_id", "_first", "_digest", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = found.withColumn("back", restored(F.col("output"), F.col("form"), plan)).collect()
    key = lambda x: (x[0] is None, x[0] or 0)
    wanted = [(r[0], *brute(plan, r[0], r[1]), r[1] or "") for r in rows]
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got), key=key) == sorted(wanted, key=key)
    assert {r._first for r in got} == {"f", None}
    forms = {r.form for r in got}
    assert forms == ({"plain", "spm"} if plan.spm == 100 else {"plain", "psm", "spm"})


def test_exception_index_leads_both_ways():
    text = "aé日😀" * 50 + "plain" + "ß"
    index = Exceptions(np.frombuffer(text.encode(), np.uint8))
    characters = np.arange(len(text) + 1)
    byte = np.array([len(text[:i].encode()) for i in characters])
    assert (index.bytes(characters) == byte).all() and (index.characters(byte) == characters).all()
    assert len(Exceptions(np.frombuffer(b"only ascii", np.uint8)).byte) == 0


def test_cuts_at_either_end_and_without_a_unit():
    n, where, chars = cuts(pa.array(["é\nb", "", None, "x"]), np.array([2, 5, 5, 0]), np.array([0, 5, 5, 1]), "line")
    assert n.tolist() == [2, 0, 0, 1]
    assert where.tolist() == [[0, 0, 0, 0], [4, 0, 0, 1]] and chars.tolist() == [[0, 0, 0, 0], [3, 0, 0, 1]]


def test_marks_that_could_be_confused_are_refused():
    for marks in (("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("<P>", "P>x", "<M>"), ("", "<S>", "<M>"), ("<P>", "<S>", "x<P>y")):
        with pytest.raises(ValueError, match="marks"):
            Plan(prefix=marks[0], suffix=marks[1], middle=marks[2])
    with pytest.raises(ValueError, match="unit"):
        Plan(unit="word")


def test_empty_table(spark):
    assert filled_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
