"""Fill-in-middle transformation: a text cut in three and put in an order in which the middle comes last.

Cuts are drawn in units, lines or code points, while texts are UTF-8 bytes.  A sparse exception index
leads from one to the other: of all characters only those of several bytes are recorded, with their
place and the bytes they have beyond one.  Up to a cut, the bytes are the code points plus the excess of
the exceptions before it, which one binary search finds; a text in ASCII has no entry and needs no search
through its characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.arrow import utf8
from martloom.llm.scratch import free, prepare, widened


@dataclass(frozen=True)
class Plan:
    """How texts are cut.

    ``seed`` and doc_id decide everything: which of ``rate`` in a hundred texts are cut, where, and
    which ``spm`` in a hundred of these have the suffix first.  ``unit``: ``line`` or ``character``.
    """

    seed: str = "7"
    rate: int = 100
    spm: int = 50
    unit: str = "line"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        if self.unit not in ("line", "character"):
            raise ValueError(f"unit must be line or character, not {self.unit!r}")
        for a in self.marks:
            for b in self.marks:
                if not a or (a in b and a is not b) or any(b.startswith(a[i:]) for i in range(1, len(a))):
                    raise ValueError(f"marks {a!r} and {b!r} could not be told from the text around them")
        if len(set(self.marks)) < 3:
            raise ValueError("marks must differ")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class Exceptions:
    """Characters of several bytes in a run of UTF-8 bytes; places are counted from its start."""

    def __init__(self, data: np.ndarray):
        self.byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        #: Excess of all exceptions before each; one entry more than exceptions.
        self.before = np.concatenate([[0], np.cumsum(excess)])
        self.character = self.byte - self.before[:-1]

    def characters(self, byte: np.ndarray) -> np.ndarray:
        """Code points before places between characters, given in bytes."""
        return byte - self.before[np.searchsorted(self.byte, byte)]

    def bytes(self, character: np.ndarray) -> np.ndarray:
        """Bytes before places given in code points."""
        return character + self.before[np.searchsorted(self.character, character)]


def _line_ends(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the lines of all texts end, in bytes, and how many of them stand before each text."""
    last = at[1:][np.diff(at) > 0]
    ends = np.union1d(np.flatnonzero(data == 0x0A) + 1, last)  # a text's end is the end of its last line
    return ends, np.searchsorted(ends, at, "right")


def cuts(texts: pa.Array, first: np.ndarray, second: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text; its two cuts in bytes and in code points, as lines of an array.

    ``first`` and ``second``: numbers whose remainder by one more than the units is a cut.
    """
    data, at = utf8(texts)
    exceptions = Exceptions(data)
    start = exceptions.characters(at)
    if unit == "line":
        ends, before = _line_ends(data, at)
        n = np.diff(before)
    else:
        n = np.diff(start)
    place = np.sort(np.stack([first % (n + 1), second % (n + 1)]), axis=0)
    if unit == "line":
        known = np.concatenate([ends, [0]])
        where = np.where(place > 0, known[before[:-1] + place - 1], at[:-1])
        chars = exceptions.characters(where)
    else:
        chars = start[:-1] + place
        where = exceptions.bytes(chars)
    return n, where - at[:-1], chars - start[:-1]


def filled_in_middle(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``docs`` with text replaced by ``output``, and n, form, prefix_chars and middle_chars.

    ``n``: units of the text.  ``form``: ``psm`` (prefix, suffix, middle, each after its mark), ``spm``
    (suffix first) or ``plain``, the text as it is: texts that are empty or hold a mark, and those the
    rate leaves.  ``prefix_chars`` and ``middle_chars``: code points of these parts, null if plain.  A null
    text is empty; a null doc_id counts as an empty one; repeated rows have the same output.  Other columns
    stay, those named like the new ones are replaced.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("n", "form", "prefix_chars", "middle_chars", "output").withColumn("text", F.coalesce("text", F.lit("")))
    digest, first, second, form = free(docs, "digest", "first", "second", "form")
    drawn = F.sha2(F.concat(F.lit(f"{plan.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)

    def number(i: int) -> Column:
        return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")

    held = F.lit(False)
    for mark in plan.marks:
        held = held | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | held | (number(2) % 100 >= plan.rate)
    chosen = F.when(plain, "plain").when(number(3) % 100 < plan.spm, "spm").otherwise("psm")
    planned = docs.withColumn(digest, drawn).withColumns({first: number(0), second: number(1), form: chosen}).drop(digest)
    schema = widened(docs.drop("text").schema, "n long, form string, prefix_chars long, middle_chars long, output string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, forms = batch.column("text"), batch.column(form).to_pylist()
            n, where, chars = cuts(texts, *(batch.column(x).to_numpy() for x in (first, second)), plan.unit)
            output = _put(texts, where, forms, plan)
            plain = pa.array([x == "plain" for x in forms], pa.bool_())
            parts = [pa.array(x, mask=plain.to_numpy(zero_copy_only=False)) for x in (chars[0], chars[1] - chars[0])]
            rest = batch.drop_columns(["text", first, second, form])
            columns = [*rest.columns, pa.array(n), batch.column(form), *parts, output]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return planned.mapInArrow(run, schema)


def _put(texts: pa.Array, where: np.ndarray, forms: list[str], plan: Plan) -> pa.Array:
    data, at = utf8(texts)
    p, s, m = (x.encode() for x in plan.marks)
    out, whole = [], memoryview(data)
    for start, end, a, b, form in zip(at[:-1].tolist(), at[1:].tolist(), *where.tolist(), forms):
        prefix, middle, suffix = whole[start : start + a], whole[start + a : start + b], whole[start + b : end]
        if form == "psm":
            out.append(b"".join((p, prefix, s, suffix, m, middle)))
        elif form == "spm":
            out.append(b"".join((s, suffix, p, prefix, m, middle)))
        else:
            out.append(bytes(whole[start:end]))
    return pa.array(out, pa.binary()).cast(pa.string())


def restored(output: Column, form: Column, plan: Plan = Plan()) -> Column:
    """The text that ``output`` was made from."""
    parts = F.split(output, "|".join(re.escape(x) for x in plan.marks), -1)
    first, second, third = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    order = F.when(form == "psm", F.concat(first, third, second)).when(form == "spm", F.concat(second, third, first))
    return F.coalesce(order, output)
