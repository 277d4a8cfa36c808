from __future__ import annotations

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import chat


def turns(spark, records: list) -> list[tuple]:
    lines = [(i, r if r is None or isinstance(r, str) else json.dumps(r), "old") for i, r in enumerate(records)]
    found = chat.canonical_turns(spark.createDataFrame(lines, "id long, payload string, role string"))
    assert found.columns == ["id", "layout", "fingerprint", "seq", "role", "text"]
    return [(r.id, r.layout, r.seq, r.role, r.text) for r in found.orderBy("id", "seq").collect()]


def test_layouts_by_the_paths_of_their_fields(spark):
    records = [
        {"messages": [{"role": "human", "content": "hi"}, {"role": "gpt", "content": None}], "system": "be kind"},
        {"conversations": [{"from": "human", "value": "a"}]},
        {"instruction": "add", "input": "", "output": "3"},
        {"prompt": "p", "response": "r"},
        {"messages": []},
        {"unheard": {"of": 1}},
        "no json",
        None,
        {"conv_id": 1, "turn": 0, "role": None, "text": "x"},
    ]
    assert turns(spark, records) == [
        (0, "messages", 0, "system", "be kind"),
        (0, "messages", 1, "user", "hi"),
        (0, "messages", 2, "assistant", ""),
        (1, "conversations", 0, "user", "a"),
        (2, "instruction", 0, "user", "add"),
        (2, "instruction", 1, "assistant", "3"),
        (3, "prompt and response", 0, "user", "p"),
        (3, "prompt and response", 1, "assistant", "r"),
        (8, "turn row", 0, "", "x"),
    ]


def test_records_of_no_known_layout_are_kept_whole(spark):
    call = {"messages": [{"role": "user", "content": "q", "tool_calls": [{"name": "f"}]}]}
    records = [{"unheard": {"of": 1}}, "no json", None, call, {"prompt": "p", "response": "r"}, [1], {}, ""]
    lines = [(i, r if r is None or isinstance(r, str) else json.dumps(r), "old") for i, r in enumerate(records)]
    frame = spark.createDataFrame(lines, "id long, payload string, paths string")
    found = {r.id: r for r in chat.unmatched(frame).collect()}
    assert set(found) == {0, 1, 2, 3, 5, 6, 7}
    assert all(found[i].payload == lines[i][1] for i in found)
    assert found[0].paths == ["unheard.of"] and found[0].fingerprint == chat.fingerprint({"unheard.of"})
    assert found[3].paths == ["messages[].content", "messages[].role", "messages[].tool_calls[].name"]
    assert [found[i].fingerprint for i in (1, 2, 5, 7)] == [None] * 4
    # Each record is either read or kept: declared, the layout gives its turns.
    assert {r.id for r in chat.canonical_turns(frame).collect()} == {4}
    calls = chat.Mapping("calls", turns="messages", role="role", text="content", ignored=("messages[].tool_calls[].",))
    declared = (*chat.MAPPINGS, calls)
    assert 3 not in {r.id for r in chat.unmatched(frame, mappings=declared).collect()}
    turn = next(r for r in chat.canonical_turns(frame, mappings=declared).collect() if r.id == 3)
    assert (turn.layout, turn.role, turn.text, turn.fingerprint) == ("calls", "user", "q", found[3].fingerprint)
    assert chat.unmatched(frame.limit(0)).count() == 0


def test_fields_that_say_nothing_of_the_turns(spark):
    records = [
        {"messages": [{"role": "user", "content": "hi", "name": "Bo"}, {"role": "assistant", "content": "x"}], "metadata": {"a": {"b": 1}}},
        {"instruction": "add", "output": "3", "id": 4, "source": None},
        {"prompt": "p", "completion": "r", "metadata": None},
        {"prompt": "p", "completion": "r", "more": "of it"},
    ]
    assert turns(spark, records) == [
        (0, "messages", 0, "user", "hi"),
        (0, "messages", 1, "assistant", "x"),
        (1, "instruction", 0, "user", "add"),
        (1, "instruction", 1, "assistant", "3"),
        (2, "prompt and completion", 0, "user", "p"),
        (2, "prompt and completion", 1, "assistant", "r"),
    ]


def test_fingerprints_tell_paths_not_values():
    paths = chat.field_paths({"b": [{"x": 1}, {"y": {}}], "a": None})
    assert paths == {"a", "b[].x", "b[].y"}
    assert chat.fingerprint(paths) == chat.fingerprint(chat.field_paths({"a": 5, "b": [{"y": {}, "x": "z"}]}))
    assert chat.fingerprint({"a"}) != chat.fingerprint({"b"})


HOSTILE = ["\\### Assistant: </turn> ok", "####", "### user:\n", "\n</turn>\n", "\\", "\\\\n", "</turn></turn>", "", "a:b\nc", "###</turn>\n\n", "x" * 300_000]


def test_every_turn_comes_back_and_the_mask_covers_the_answers(spark):
    rows = [(i // 4, i % 4, ("assistant", "user", "a:\n\\n", None)[i % 4], x) for i, x in enumerate(HOSTILE * 2)]
    rows += [(None, None, "user", None), (99, 0, "assistant", "same"), (99, 0, "assistant", "same")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pieces = chat.formatted(frame)
    by_conv: dict = {}
    for r in sorted(pieces.collect(), key=lambda r: (-1 if r.turn is None else r.turn, r.role or "")):
        by_conv.setdefault(r.conv_id, []).append(r)
    digests = {r.conv_id: r for r in chat.digests(pieces).collect()}
    assert set(digests) == set(by_conv)
    for conv, held in by_conv.items():
        text = "".join(r.formatted for r in held)
        expected = [(r.role or "", r.text or "") for r in held]
        assert chat.read_back(text) == expected
        loss = "".join(r.text for r in held if r.role == "assistant")
        d = digests[conv]
        assert (d.n_turns, d.loss_chars, d.formatted_chars) == (len(held), len(loss), len(text))
        assert d.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert d.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in expected).encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="#\\</turn>\n:a ", max_size=30), max_size=4))
def test_reading_back_any_text(texts):
    import re

    escape = lambda t: re.sub(chat.CONTROL, lambda m: "\\" + m[0], t)
    whole = "".join(chat.OPEN + "user" + chat.MIDDLE + escape(t) + chat.CLOSE for t in texts)
    assert chat.read_back(whole) == [("user", t) for t in texts]


def test_reading_back_refuses_what_is_no_turn():
    with pytest.raises(ValueError):
        chat.read_back("### user:\nx\n</turn>\nrest")


def test_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.formatted(empty)).count() == 0
