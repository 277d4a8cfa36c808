"""URL filters by a bit-parallel wildcard automaton.

Rules and block patterns are globs over a canonical address: a dot, the host in lower case, the path.
Each glob becomes a run of bits, one for each of its steps and one for its start.  A bit is set while
what has been read can be the glob's beginning up to there.  All globs together are a few machine words,
and one byte of an address moves all of them at once (Shift-And, Baeza-Yates and Gonnet, 1992; wildcards
as bits that stay, Navarro and Raffinot, 2002):

    D = ((D << 1) & step[byte]) | (D & stay[byte])

Addresses of a batch are read side by side, one place at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.arrow import utf8
from martloom.llm.scratch import free, prepare, widened

_U = np.uint64
#: Bits of one automaton; more globs than fit are read in further passes, so that what every task gets is bounded.
PART_BITS = 1 << 15
_SLASH = ord("/")


@dataclass(frozen=True)
class Rule:
    """A verdict on a host with all its subdomains, and the paths there that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{escaped(self.host)}{escaped(self.path)}**"


# The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: What decides where no rule fits: an address that one of these matches is blocked, any other allowed.
BLOCKED = (
    "*.spam-**",
    "*-spam.**",
    "*.cheap-**",
    "*-pills.**",
    "*casino*",
    "*casino*/**",
    "**/wp-login.php*",
    "**.exe",
    "**.apk",
)


def escaped(text: str) -> str:
    """A glob that matches this text alone."""
    return "".join(f"\\{c}" if c in "\\*?" else c for c in text)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; '' where there is none."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _steps(glob: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Bytes that lead to each step, and bytes that leave it as it is; the first entry is the start.

    ``*`` is any run without a slash, ``**`` any run, ``?`` one character other than a slash, and a
    backslash takes the next character as it is.
    """
    nothing = np.zeros(256, bool)
    inner = np.zeros(256, bool)
    inner[0x80:0xC0] = True  # bytes that go on with a character
    step, stay, at = [nothing], [nothing.copy()], 0
    while at < len(glob):
        c = glob[at]
        at += 1
        if c == "*":
            wide = glob[at : at + 1] == "*"
            at += wide
            stay[-1] = np.ones(256, bool)
            stay[-1][_SLASH] = wide
        elif c == "?":
            one = ~inner
            one[_SLASH] = False
            step.append(one)
            stay.append(inner.copy())
        else:
            if c == "\\":
                if at == len(glob):
                    raise ValueError(f"glob ends in a backslash: {glob}")
                c = glob[at]
                at += 1
            for byte in c.encode():
                step.append(np.arange(256) == byte)
                stay.append(nothing.copy())
    return step, stay


class Automaton:
    """Globs as masks of 64-bit words, by byte.  ``ranks``: the place of each among all globs."""

    def __init__(self, globs: Sequence[str], ranks: Sequence[int]):
        parts = [_steps(g) for g in globs]
        first = np.cumsum([0, *(len(step) for step, _ in parts)])
        width = -(-int(first[-1]) // 64)
        self.ranks = np.array(ranks)
        self.start, final = np.zeros(width, _U), first[1:] - 1
        self.step, self.stay = np.zeros((256, width), _U), np.zeros((256, width), _U)
        for at, (step, stay) in zip(first, parts):
            self.start[at // 64] |= _U(1) << _U(at % 64)
            for i in range(len(step)):
                word, bit = (at + i) // 64, _U(1) << _U((at + i) % 64)
                self.step[step[i], word] |= bit
                self.stay[stay[i], word] |= bit
        self.word, self.bit = final // 64, (final % 64).astype(_U)
        ends = np.zeros(width, _U)
        np.bitwise_or.at(ends, self.word, _U(1) << self.bit)
        self.on = ~ends  # a finished glob must not lead into its neighbour's start

    def best(self, addresses: pa.Array) -> np.ndarray:
        """The least rank of a glob that matches each whole address, -1 where none does."""
        data, at = utf8(addresses)
        size = np.diff(at)
        order = np.argsort(-size, kind="stable")
        begin, size = at[:-1][order], size[order]
        state = np.repeat(self.start[None, :], len(order), 0)
        open_ = np.searchsorted(-size, -np.arange(1, size[0] + 1 if len(size) else 1), "right")
        for place, rows in enumerate(open_.tolist()):
            byte = data[begin[:rows] + place]
            now = state[:rows]
            moved = now & self.on
            shifted = moved << _U(1)
            shifted[:, 1:] |= moved[:, :-1] >> _U(63)
            state[:rows] = (shifted & self.step[byte]) | (now & self.stay[byte])
        ended = (state[:, self.word] >> self.bit) & _U(1)
        ranked = np.where(ended.astype(bool), self.ranks, np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
        found = np.empty(len(order), np.int64)
        found[order] = np.where(ranked == np.iinfo(np.int64).max, -1, ranked)
        return found


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES, blocked: Sequence[str] = BLOCKED, part_bits: int = PART_BITS) -> DataFrame:
    """Adds host, path, rule and verdict to ``pages``, from the column url alone.

    The rule with the longest name that fits decides (of equally long ones the first in the list), and
    ``rule`` is its name.  Where none fits, ``rule`` is null and the verdict is block if one of the
    ``blocked`` globs matches, else allow.  A url that is null or has no ``://`` has an empty host and path,
    which no rule fits and no sensible glob matches.  Other columns stay, those named like the new ones
    are replaced; repeated rows are judged each.
    """
    prepare(pages.sparkSession)
    ordered = [(r.name, r.verdict, r.glob) for r in sorted(rules, key=lambda r: -len(r.name))] + [(None, "block", g) for g in blocked]
    pages = pages.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))}).withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    rank, address = free(pages, "rank", "address")
    seen = pages.withColumns({rank: F.lit(len(ordered)).cast("long"), address: F.concat(F.lit("."), "host", "path")})
    for part in _parts(ordered, part_bits):
        seen = seen.mapInArrow(_read(pages.sparkSession.sparkContext.broadcast(part), rank, address), widened(seen.drop(rank).schema, f"`{rank}` long"))
    return seen.drop(rank, address)


def _parts(ordered: list[tuple], part_bits: int) -> Iterator[tuple[Automaton, list, list]]:
    """Automata over successive globs, with the names and verdicts of all their globs."""
    at = 0
    while at < len(ordered):
        end, bits = at, 0
        while end < len(ordered) and (end == at or bits + 4 * len(ordered[end][2]) + 1 <= part_bits):
            bits += 4 * len(ordered[end][2]) + 1  # a character has up to four bytes
            end += 1
        names, verdicts, globs = zip(*ordered[at:end])
        yield Automaton(globs, range(at, end)), names, verdicts
        at = end


def _read(shared: Broadcast, rank: str, address: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, names, verdicts = shared.value
        for batch in batches:
            best, before = automaton.best(batch.column(address)), batch.column(rank).to_numpy(zero_copy_only=False)
            won = (best >= 0) & (best < before)
            mask, place = pa.array(won), pa.array(np.where(won, best - automaton.ranks[0], 0))
            new = {
                "rule": pa.array(names, pa.string()).take(place),
                "verdict": pa.array(verdicts, pa.string()).take(place),
                rank: pa.array(best),
            }
            kept = batch.drop_columns([rank])
            columns = {n: pc.if_else(mask, new[n], batch.column(n)) if n in new else batch.column(n) for n in kept.schema.names}
            columns[rank] = pc.if_else(mask, new[rank], batch.column(rank))
            yield pa.RecordBatch.from_pydict(columns)

    return run
