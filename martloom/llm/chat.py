"""Chat records of many layouts as canonical turns, and turns as training text with a loss mask.

A record is a JSON object.  Its schema fingerprint is a hash of the paths of its fields, and selects
the declared mapping that says where roles and texts stand.  Formatting writes each turn between
control strings and escapes those inside texts, so that reading back gives every turn unchanged.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.scratch import prepare, widened


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout stand.

    ``parts``: (role, paths) of turns that are single fields; several paths are joined by an empty
    line.  ``turns``: a list of objects with their own role and text fields ("" for the record
    itself).  ``optional``: paths that may be missing.  ``ignored``: paths that may stand there besides and say
    nothing of the turns; one that ends in a dot means all fields below it.
    """

    name: str
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    turns: str | None = None
    role: str = ""
    text: str = ""
    also: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    ignored: tuple[str, ...] = ()

    def without_ignored(self, paths: set[str]) -> set[str]:
        below = tuple(x for x in self.ignored if x.endswith("."))
        return {p for p in paths if p not in self.ignored and not (below and p.startswith(below))}

    def paths(self) -> set[str]:
        own = {p for _, paths in self.parts for p in paths} | set(self.also)
        if self.turns is not None:
            own |= {f"{self.turns}[].{x}" if self.turns else x for x in (self.role, self.text)}
        return own

    def fingerprints(self) -> Iterator[str]:
        for left_out in chain.from_iterable(combinations(self.optional, n) for n in range(len(self.optional) + 1)):
            yield fingerprint(self.paths() - set(left_out))
            if self.turns:  # an empty list shows none of its fields
                yield fingerprint({p for p in self.paths() - set(left_out) if not p.startswith(self.turns)} | {f"{self.turns}[]"})


MAPPINGS = (
    Mapping("turn row", turns="", role="role", text="text", also=("conv_id", "turn")),
    Mapping("messages", turns="messages", role="role", text="content", also=("system", "id"), optional=("system", "id"), parts=(("system", ("system",)),), ignored=("messages[].name", "messages[].id", "metadata", "metadata.", "source")),
    Mapping("conversations", turns="conversations", role="from", text="value", also=("id",), optional=("id",), ignored=("metadata", "metadata.", "source")),
    Mapping("prompt and response", parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",), ignored=("id", "metadata", "metadata.", "source")),
    Mapping("prompt and completion", parts=(("user", ("prompt",)), ("assistant", ("completion",))), ignored=("id", "metadata", "metadata.", "source")),
    Mapping("instruction", parts=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))), optional=("system", "input"), ignored=("id", "metadata", "metadata.", "source")),
    Mapping("question and answer", parts=(("system", ("context",)), ("user", ("question",)), ("assistant", ("answer",))), optional=("context",), ignored=("id", "metadata", "metadata.", "source")),
)
#: Names that layouts give the three roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(value: object, at: str = "") -> set[str]:
    """Paths of all fields that hold no further fields; ``[]`` stands for any item of a list."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(x, f"{at}.{k}" if at else str(k)) for k, x in value.items()))
    if isinstance(value, list):
        return set().union(*(field_paths(x, f"{at}[]") for x in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def registry(mappings: tuple[Mapping, ...]) -> dict[str, list[Mapping]]:
    """Mappings by the fingerprints they declare; those of one fingerprint in their order."""
    known: dict[str, list[Mapping]] = {}
    for mapping in mappings:
        for key in mapping.fingerprints():
            known.setdefault(key, []).append(mapping)
    return known


def mapping_of(paths: set[str], mappings: tuple[Mapping, ...], known: dict[str, list[Mapping]]) -> Mapping | None:
    """The first mapping with this fingerprint, or the first that has it once the fields it ignores are left out."""
    exact = known.get(fingerprint(paths))
    if exact is not None:
        return exact[0]
    for mapping in mappings:
        if mapping.ignored:
            left = mapping.without_ignored(paths)
            if len(left) < len(paths) and mapping in known.get(fingerprint(left), ()):
                return mapping
    return None


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    """Role and text of each turn; the record's own role names, or the canonical one of a known alias."""
    found = []
    for role, paths in mapping.parts:
        held = [_text(record[p]) for p in paths if p in record]
        held = [x for x in held if x] or held[:1]
        if held and (role != "system" or held[0]):
            found.append((role, "\n\n".join(held)))
    if mapping.turns is not None:
        for turn in record[mapping.turns] if mapping.turns else [record]:
            role = _text(turn.get(mapping.role))
            found.append((ROLES.get(role, role) if mapping.turns else role, _text(turn.get(mapping.text))))
    return found


def canonical_turns(records: DataFrame, payload: str = "payload", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """One row for each turn of each record: its other columns, ``layout``, ``fingerprint``, ``seq``, ``role``, ``text``.

    ``payload`` names the JSON column, which goes; columns named like the new ones are replaced.  Null texts
    and roles are empty.  A record without turns gives none.  Nor does a record of no known layout, null or no
    JSON object; ``unmatched`` has all of these, with their payload.
    """
    prepare(records.sparkSession)
    added = "layout string, fingerprint string, seq int, role string, text string"
    rest = records.drop(*{"layout", "fingerprint", "seq", "role", "text"} - {payload})
    known = registry(mappings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            from_row, out = [], {name: [] for name in ("layout", "fingerprint", "seq", "role", "text")}
            for row, line in enumerate(batch.column(payload).to_pylist()):
                for values in _record_turns(line, mappings, known):
                    from_row.append(row)
                    for name, value in zip(out, values):
                        out[name].append(value)
            kept = batch.drop_columns([payload]).take(pa.array(from_row, pa.int64()))
            new = [pa.array(x, pa.int32() if n == "seq" else pa.string()) for n, x in out.items()]
            yield pa.RecordBatch.from_arrays([*kept.columns, *new], [*kept.schema.names, *out])

    return rest.mapInArrow(run, widened(rest.drop(payload).schema, added))


def unmatched(records: DataFrame, payload: str = "payload", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """The records that ``canonical_turns`` cannot read, whole, with ``fingerprint`` and ``paths``, so that their layout can be declared.

    ``paths``: the paths of their fields, sorted; both null for a payload that is null or no JSON object.
    Columns of the names added are replaced.
    """
    prepare(records.sparkSession)
    rest = records.drop(*{"fingerprint", "paths"} - {payload})
    known = registry(mappings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, found = [], [], []
            for row, line in enumerate(batch.column(payload).to_pylist()):
                record = _record(line)
                paths = None if record is None else field_paths(record)
                if paths is None or mapping_of(paths, mappings, known) is None:
                    rows.append(row)
                    keys.append(None if paths is None else fingerprint(paths))
                    found.append(None if paths is None else sorted(paths))
            kept = batch.take(pa.array(rows, pa.int64()))
            new = [pa.array(keys, pa.string()), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*kept.columns, *new], [*kept.schema.names, "fingerprint", "paths"])

    return rest.mapInArrow(run, widened(rest.schema, "fingerprint string, paths array<string>"))


def _record(line: str | None) -> dict | None:
    try:
        record = json.loads(line) if line is not None else None
    except ValueError:
        return None
    return record if isinstance(record, dict) else None


def _record_turns(line: str | None, mappings: tuple[Mapping, ...], known: dict[str, list[Mapping]]) -> list[tuple]:
    record = _record(line)
    paths = set() if record is None else field_paths(record)
    mapping = mapping_of(paths, mappings, known) if record is not None else None
    if mapping is None:
        return []
    key = fingerprint(paths)
    return [(mapping.name, key, i, *turn) for i, turn in enumerate(turns_of(record, mapping))]


# The template.  A backslash inside a text or a role is doubled, and one is put before what would
# begin a control string; a role also hides its colons and line ends.
OPEN, MIDDLE, CLOSE = "### ", ":\n", "\n</turn>\n"
CONTROL = r"\\|#(?=##)|<(?=/turn>)"
_PIECE = re.compile(r"### ((?:\\.|[^\\:\n])*):\n((?:[^\\\n]+|\\.|\n(?!</turn>\n))*)\n</turn>\n", re.DOTALL)


def formatted(turns: DataFrame) -> DataFrame:
    """Adds to each turn its piece of the training text, and where in it the loss counts.

    ``formatted``: pieces in order of turns make up the text of a conversation.  ``loss_start`` and
    ``loss_length``: the text of an assistant's turn, in code points of the piece; null for others.
    A null role or text is empty.
    """
    role = F.regexp_replace(F.coalesce("role", F.lit("")), CONTROL + "|:", r"\\$0")
    role = F.replace(role, F.lit("\n"), F.lit("\\n"))
    text = F.regexp_replace(F.coalesce("text", F.lit("")), CONTROL, r"\\$0")
    start = F.length(role) + len(OPEN) + len(MIDDLE)
    spoken = F.col("role") == "assistant"
    return turns.withColumns(
        {
            "formatted": F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE)),
            "loss_start": F.when(spoken, start),
            "loss_length": F.when(spoken, F.length(text)),
        }
    )


def unescaped(text: str, role: bool = False) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if role and m[1] == "n" else m[1], text, flags=re.DOTALL)


def read_back(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation; an error if anything else stands in it."""
    found, at = [], 0
    while at < len(text):
        piece = _PIECE.match(text, at)
        if piece is None:
            raise ValueError(f"no turn begins at {at}")
        found.append((unescaped(piece[1], role=True), unescaped(piece[2])))
        at = piece.end()
    return found


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(pieces: DataFrame) -> DataFrame:
    """Counts and hashes of each conversation, read back from its pieces in order of turn, role and text.

    ``pieces``: conv_id, turn, role, text and the columns of ``formatted``.  Rows without conv_id are
    one conversation, rows without turn its first.  A task goes through sorted pieces and holds one
    at a time, so the length of a conversation is not bounded by memory; but a hash follows the order
    of the text, and so one conversation is read in one task.
    """
    prepare(pieces.sparkSession)
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: _Conversation | None = None
        for batch in batches:
            done = []
            for conv, piece, start, length in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if state is None or state.conv != conv:
                    done += [state.row()] if state else []
                    state = _Conversation(conv)
                state.add(piece, start, length)
            if done:
                yield _rows(done)
        if state:
            yield _rows([state.row()])

    return ordered.select("conv_id", "formatted", "loss_start", "loss_length").mapInArrow(run, _DIGEST)


class _Conversation:
    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, start: int | None, length: int | None) -> None:
        for role, text in read_back(piece):
            self.turns += 1
            self.said.update(f"{role}\n{text}\n".encode())
        self.chars += len(piece)
        if start is not None:
            masked = unescaped(piece[start : start + length])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = [x.split()[0] for x in _DIGEST.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)
