"""Benchmark decontamination: windows of a text as long as an item, found by SimHash, checked exactly.

A SimHash of a run of words is 64 bits: each bit is the sign of a sum over the run's shingles (five
words, weighted by how often they occur in the run), so similar runs differ in few bits.  Windows of
every item length slide over the whole text.  Fingerprints are cut into blocks of bits; two that
differ in at most ``radius`` bits agree up to ``radius // blocks`` bits in one block at least.  A window
and an item that pass this in a block, and then in the whole print, are compared by exact weighted shingle
similarity.  A text shorter than an item is one window, the whole text; the items that share enough of its
shingles are compared exactly.

A window has similarity 0 with every item it shares no shingle with.  So a window is only ever held against
the items that own one of its shingles, which a list from shingles to items names: this drops no pair that
could match, and what a text costs does not grow with the number of items it has nothing of.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.arrow import Words, mix64, shingles, words
from martloom.llm.scratch import prepare, widened

_U = np.uint64
SIZE, SIMILARITY = 5, 0.8
#: At similarity 0.8 fingerprints differ in 10 bits on average; beyond 22 lie 3 pairs in 100,000.
RADIUS, BLOCKS = 22, 8
#: Bytes of benchmark text that every task gets at once; a larger benchmark is gone through in parts.
PART_BYTES = 4 << 20


class Items:
    """Benchmark items of one part, and what finds them: lists from shingles to items, blocks of fingerprints."""

    def __init__(self, ids: list[int], texts: list[str], radius: int, blocks: int):
        found = words(pc.utf8_lower(pa.array(texts, pa.string())))
        self.length = np.diff(found.first)
        self.ids, self.radius, self.blocks = pa.array(ids, pa.int64()), radius, blocks
        self.shingles = [_counted(found.hash[found.first[i] : found.first[i + 1]]) for i in range(len(texts))]
        self.prints = np.array([fingerprint(*x) for x in self.shingles], _U)
        #: Which differences of two blocks are within the part of the radius that falls to one.
        self.near = _block_tables(np.zeros(1, _U), radius, blocks)
        self.known = {}
        #: Shingles in order, and the item of each.
        self.holders = {}
        for size in sorted({min(SIZE, n) for n in self.length.tolist()} - {0}):
            held = [i for i, n in enumerate(self.length.tolist()) if n and min(SIZE, n) == size]
            self.known[size] = np.unique(np.concatenate([self.shingles[i][0] for i in held]))
            hashes = np.concatenate([self.shingles[i][0] for i in held])
            turn = np.argsort(hashes, kind="stable")
            self.holders[size] = hashes[turn], np.repeat(held, [len(self.shingles[i][0]) for i in held])[turn]


def _counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of one run of words, each with its count; of all its words if they are fewer than five."""
    return np.unique(_runs(hashes, min(SIZE, max(len(hashes), 1))), return_counts=True)


def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
    whole = np.array([0, len(hashes)])
    return shingles(Words(hashes, np.zeros(len(hashes), np.int64), None, None, whole), size)[0]


def _signs(hashes: np.ndarray) -> np.ndarray:
    """64 columns of 1 and -1."""
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def _folded(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(_U).ravel()


def fingerprint(hashes: np.ndarray, counts: np.ndarray) -> np.uint64:
    if not len(hashes):
        return _U(0)
    return _folded((_signs(mix64(hashes)) * counts[:, None].astype(np.int32)).sum(0, keepdims=True))[0]


def _block_tables(prints: np.ndarray, radius: int, blocks: int) -> list[np.ndarray]:
    """For each block of bits, which of its values are within ``radius // blocks`` bits of an item's."""
    width, near = 64 // blocks, radius // blocks
    flips = [sum(1 << b for b in c) for n in range(near + 1) for c in combinations(range(width), n)]
    tables = []
    for k in range(blocks):
        values = (prints >> _U(k * width)) & _U(2**width - 1)
        table = np.zeros(2**width, bool)
        for flip in flips:
            table[(values ^ _U(flip)).astype(np.int64)] = True
        tables.append(table)
    return tables


def matches_in(text_words: np.ndarray, items: Items, similarity: float) -> list[tuple[int, int, int, float]]:
    """Matches in one text, given as word hashes: place of the item, first word, words, similarity (the best window of each item)."""
    n, best = len(text_words), {}
    for size, (hashes, holders) in items.holders.items():
        if n < size:
            continue
        runs = _runs(text_words, size)
        low, high = np.searchsorted(hashes, runs, "left"), np.searchsorted(hashes, runs, "right")
        times = high - low
        if not times.any():
            continue
        best |= _shortened(runs, size, n, items, similarity)
        spot = np.repeat(np.arange(len(runs)), times)  # each shingle of the text beside each item that owns it
        owner = holders[np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())]
        lengths = items.length[owner]
        for length in np.unique(lengths[lengths <= n]).tolist():
            here = lengths == length
            for start, item in _within(runs, spot[here], owner[here], length - size + 1, n - length, items):
                window = np.unique(runs[start : start + length - size + 1], return_counts=True)
                value = _similarity(window, items.shingles[item])
                if value >= similarity and value > best.get(item, (0, 0, 0.0))[2]:
                    best[item] = (start, length, value)
    return [(item, *match) for item, match in sorted(best.items())]


def _shortened(runs: np.ndarray, size: int, n: int, items: Items, similarity: float) -> dict[int, tuple[int, int, float]]:
    """Matches of the whole text with items that are longer."""
    hashes, counts = window = np.unique(runs, return_counts=True)
    sorted_, holders = items.holders[size]
    low, high = np.searchsorted(sorted_, hashes, "left"), np.searchsorted(sorted_, hashes, "right")
    times = high - low
    at = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
    shared = np.bincount(holders[at], np.repeat(counts, times), minlength=len(items.length))  # no fewer than really shared
    held = np.maximum(items.length - size + 1, 1)
    found = {}
    for item in np.flatnonzero((items.length > n) & (shared > 0) & (shared >= similarity * held - 1e-6)).tolist():
        value = _similarity(window, items.shingles[item])
        if value >= similarity:
            found[item] = (0, n, value)
    return found


def _starts(spots: np.ndarray, before: int, last: int) -> np.ndarray:
    """Starts of all windows that hold one of the spots."""
    edge = np.zeros(last + 2, np.int64)
    np.add.at(edge, np.clip(spots - before, 0, last + 1), 1)
    np.add.at(edge, np.clip(spots + 1, 0, last + 1), -1)
    return np.flatnonzero(np.cumsum(edge)[: last + 1] > 0)


#: Windows held against items at a time.
PAIRS = 1 << 18


def _within(runs: np.ndarray, spot: np.ndarray, owner: np.ndarray, held: int, last: int, items: Items) -> Iterator[tuple[int, int]]:
    """Windows of ``held`` shingles, by start, that have a shingle of an item and a fingerprint within the radius of its.

    ``spot`` and ``owner``: shingles of the text, by place, and items that own them; ``last``: the last start.
    Starts come in order for each item.
    """
    order = np.lexsort((spot, owner))
    spot, owner = spot[order], owner[order]
    low, high = np.maximum(spot - held + 1, 0), np.minimum(spot, last)
    same = owner[1:] == owner[:-1]
    low[1:] = np.where(same, np.maximum(low[1:], high[:-1] + 1), low[1:])  # a window counts once for an item
    times = np.maximum(high - low + 1, 0)
    starts = _starts(np.unique(spot), held - 1, last)
    prints, width = _prints(runs, starts, held), 64 // items.blocks
    first = 0
    ends = np.cumsum(times)
    while first < len(times):
        stop = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS, "right")))
        n = times[first:stop]
        start = np.repeat(low[first:stop] - np.cumsum(n) + n, n) + np.arange(n.sum())
        item = np.repeat(owner[first:stop], n)
        apart = prints[np.searchsorted(starts, start)] ^ items.prints[item]
        near = np.zeros(len(apart), bool)
        for k, table in enumerate(items.near):
            near |= table[((apart >> _U(k * width)) & _U(2**width - 1)).astype(np.int64)]
        near &= np.bitwise_count(apart) <= items.radius
        yield from zip(start[near].tolist(), item[near].tolist())
        first = stop


def _prints(runs: np.ndarray, starts: np.ndarray, held: int) -> np.ndarray:
    """Fingerprints of the windows of ``held`` shingles at ``starts``, which are in order."""
    found, ends = [np.zeros(0, _U)], np.flatnonzero(np.diff(starts) > 1) + 1
    for part in (x for group in np.split(starts, ends) for x in np.split(group, range(4096, len(group), 4096))):
        if len(part):
            signs = _signs(mix64(runs[part[0] : part[-1] + held]))
            total = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs, 0, dtype=np.int32)])
            found.append(_folded(total[held:] - total[:-held]))
    return np.concatenate(found)


def _similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    smaller = np.minimum(a[1][i], b[1][j]).sum()
    return float(smaller / (a[1].sum() + b[1].sum() - smaller))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """The benchmark items that texts hold: columns of ``docs`` but text, item_id, first_word, n_words, similarity.

    One row for each row of ``docs`` and item with a window of the item's length at least that similar;
    the best such window, the first if several.  A text with fewer words than the item is its only window.  Words are compared in lower case.  Texts and items that
    are null or without words match nothing; equal items match each on its own; an item of fewer than
    five words is one shingle.  Columns named like the new ones are replaced.
    """
    docs = docs.drop("item_id", "first_word", "n_words", "similarity")
    schema = widened(docs.drop("text").schema, "item_id long, first_word int, n_words int, similarity double")
    found = docs.sparkSession.createDataFrame([], schema)
    for items in _parts(benchmark, radius, blocks):
        found = found.unionByName(docs.mapInArrow(_search(items, similarity), schema))
    return found


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, in the sense of ``contaminated``."""
    for items in _parts(benchmark, radius, blocks):
        docs = docs.mapInArrow(_without(items, similarity), docs.schema)
    return docs


def _parts(benchmark: DataFrame, radius: int, blocks: int) -> Iterator[Broadcast]:
    """Tables of the benchmark's items, of a bounded size each, for every task."""
    spark = benchmark.sparkSession
    prepare(spark)
    items = benchmark.filter("text IS NOT NULL").select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = -(-size // PART_BYTES)
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").toArrow()
        tables = Items(rows.column("item_id").to_pylist(), rows.column("text").to_pylist(), radius, blocks)
        yield spark.sparkContext.broadcast(tables)


def _hits(part: pa.RecordBatch, items: Items, similarity: float) -> list[tuple]:
    """Row and match, for each match in the texts of a batch."""
    found = words(pc.utf8_lower(part.column("text")))
    touched = set()
    for size, values in items.known.items():  # rows with a shingle of some item
        hashes, rows, _ = shingles(found, size)
        if len(hashes):
            hit = values[np.minimum(np.searchsorted(values, hashes), len(values) - 1)] == hashes
            touched.update(rows[hit].tolist())
    return [
        (row, *match)
        for row in sorted(touched)
        for match in matches_in(found.hash[found.first[row] : found.first[row + 1]], items, similarity)
    ]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            yield batch.slice(at, 500)


def _search(shared: Broadcast, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            hits = _hits(part, shared.value, similarity)
            if hits:
                row, item, first, length, value = zip(*hits)
                kept = part.drop_columns(["text"]).take(pa.array(row, pa.int64()))
                new = [shared.value.ids.take(pa.array(item, pa.int64())), pa.array(first, pa.int32()), pa.array(length, pa.int32()), pa.array(value, pa.float64())]
                yield pa.RecordBatch.from_arrays([*kept.columns, *new], [*kept.schema.names, "item_id", "first_word", "n_words", "similarity"])

    return run


def _without(shared: Broadcast, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            keep = np.ones(part.num_rows, bool)
            keep[[row for row, *_ in _hits(part, shared.value, similarity)]] = False
            yield part.filter(pa.array(keep))

    return run
