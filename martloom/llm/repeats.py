"""Removal of long byte strings that occur more than once, in one document or several.

A window is any run of ``length`` bytes of a text.  Its anchor is the place of the 48-byte gram of least
hash in it, the first of several: equal windows have their anchors at the same place, so windows need
only be compared where their anchors' grams agree.  All windows of one anchor are consecutive; the bytes
they cover are the anchor's region.  Regions whose gram is found once in the corpus hold no repeat and
are never moved.  The others meet by gram, equal ones as one.

Where a gram has several different regions, the strings that begin at their anchors are suffix sorted,
and so are the strings that lead up to them, backwards.  Two regions share a window if what they share
after and before the anchor adds up to its length.

A gram with very many different regions is not gathered: its windows are cut down to parts that can be
equal, and counted one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.arrow import _BYTE, mix64, powers, utf8
from martloom.llm.scratch import free, prepare, stored, widened
from martloom.llm.suffixes import ordered

_U = np.uint64
LENGTH, GRAM = 400, 48
#: Different regions of a gram that are sorted in one task.
LIMIT = 20_000
#: Windows of a region that are told apart together, where a gram has more.
BLOCK = 32
_INVERSE = pow(0xD6E8FEB86659FD93, -1, 2**64)


def text_key() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def anchors(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, place, gram, first and last window of each anchor; places count from the start of the data."""
    none = np.zeros(0, np.int64)
    window, n = length - GRAM + 1, len(data) - GRAM + 1
    size = np.diff(at)
    if n < window or not (size >= length).any():
        return none, none, none.astype(_U), none, none
    forward = powers(len(data))
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_BYTE[data] * forward, dtype=_U)])
    gram = mix64((sums[GRAM:] - sums[:-GRAM]) * _inverse_powers(n))
    ranked = (gram & _U(2**64 - 2**24)) | np.arange(n, dtype=_U)  # a batch has less than 2**24 bytes, or is one text
    if n >= 2**24:
        ranked = _wide(gram)
    blocks = np.full(-(-n // window) * window, _U(2**64 - 1))
    blocks[:n] = ranked
    blocks = blocks.reshape(-1, window)
    before = np.minimum.accumulate(blocks, 1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(after[: n - window + 1], before[window - 1 : n])
    starts = np.arange(len(least))
    row = np.searchsorted(at, starts, "right") - 1
    inside = starts + length <= at[1:][row]
    starts, row, least = starts[inside], row[inside], least[inside]
    place = (least & _U(2**24 - 1)).astype(np.int64) if n < 2**24 else _narrow(least, ranked)
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    return row[first], place[first], gram[place[first]], starts[first], starts[last]


def _wide(gram: np.ndarray) -> np.ndarray:
    """Order of the grams, equal ones by place; for texts of 16 MB and more."""
    ranked = np.empty(len(gram), _U)
    ranked[np.lexsort((np.arange(len(gram)), gram & _U(2**64 - 2**24)))] = np.arange(len(gram), dtype=_U)
    return ranked


def _narrow(least: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    place = np.empty(len(ranked), np.int64)
    place[ranked.astype(np.int64)] = np.arange(len(ranked))
    return place[least.astype(np.int64)]


_INVERSES = np.ones(1, _U)


def _inverse_powers(n: int) -> np.ndarray:
    global _INVERSES
    if len(_INVERSES) < n:
        base = np.full(max(n, 2 * len(_INVERSES)), _U(_INVERSE), _U)
        base[0] = 1
        _INVERSES = np.multiply.accumulate(base)
    return _INVERSES[:n]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about 1 MB."""
    low, size = 0, 0
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_pylist()
    for i, n in enumerate(sizes):
        if size and size + n > 1 << 20:
            yield batch.slice(low, i - low)
            low, size = i, 0
        size += n
    if low < batch.num_rows:
        yield batch.slice(low)


def _grams(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                row, _, gram, _, _ = anchors(*utf8(part.column("text")), length)
                order = np.lexsort((gram, row))
                r, g = row[order], gram[order]
                new = np.ones(len(r), bool)
                new[1:] = (r[1:] != r[:-1]) | (g[1:] != g[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(r)))
                rows, firsts = np.unique(r[at], return_index=True)
                offsets = pa.array(np.append(firsts, len(at)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (g[at].view(np.int64), times)]
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(rows)), *lists], ["key", "grams", "times"])

    return run


_REGION = "key binary, gram long, ahead int, region binary, id binary, starts array<int>"


def _regions(length: int):
    """Regions of the grams listed for each text: once each, with all windows they start at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                data, at = utf8(part.column("text"))
                raw = data.tobytes()
                row, place, gram, first, last = anchors(data, at, length)
                keys, wanted = part.column("key").to_pylist(), [set(x) for x in part.column("grams").to_pylist()]
                held: dict[tuple, list[int]] = {}
                for r, p, g, low, high in zip(row.tolist(), place.tolist(), gram.view(np.int64).tolist(), first.tolist(), last.tolist()):
                    if g in wanted[r]:
                        held.setdefault((r, g, p - low, raw[low : high + length]), []).append(low - int(at[r]))
                rows = [
                    (keys[r], g, ahead, region, hashlib.md5(b"%d %d " % (g, ahead) + region).digest(), starts)
                    for (r, g, ahead, region), starts in held.items()
                ]
                yield _batch(rows, _REGION)

    return run


_TYPES = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, _TYPES[t]) for x, t in zip(columns, kinds)], names)


def shared_windows(regions: list[tuple[int, bytes]], length: int) -> list[list[tuple[int, int]]]:
    """For each different region of a gram, given with the bytes ahead of its anchor: runs of windows that another one has."""
    after, shares_after = ordered([region[ahead:] for ahead, region in regions])
    before, shares_before = ordered([region[:ahead][::-1] for ahead, region in regions])
    rank_a, rank_b = np.empty(len(regions), np.int64), np.empty(len(regions), np.int64)
    rank_a[after], rank_b[before] = np.arange(len(regions)), np.arange(len(regions))
    windows = np.array([len(region) - length + 1 for _, region in regions])
    ahead = np.array([a for a, _ in regions])
    held = [np.zeros(n + 1, np.int64) for n in windows]
    # A shared window has at least half its bytes on one side of the anchor.
    sides = ((after, shares_after, rank_b, np.array(shares_before)), (before, shares_before, rank_a, np.array(shares_after)))
    for main, shares, other_rank, other_shares in sides:
        for group in _alike(main, shares, length // 2):
            here, mine = np.array([x for x, _ in group]), np.array([x for _, x in group])
            turn = np.argsort(other_rank[here])
            ranks = other_rank[here][turn]
            theirs = np.zeros(len(here), np.int64)
            theirs[turn[1:]] = [other_shares[a + 1 : b + 1].min() for a, b in zip(ranks, ranks[1:])]
            for i, x in enumerate(here):
                on_main, on_other = _reach(mine, np.arange(len(here)), i), _reach(theirs[turn], np.argsort(turn), i)
                r, b = (on_main, on_other) if main is after else (on_other, on_main)
                _mark(held[x], int(ahead[x]), r, b, length, i)
    return [_runs(np.cumsum(x[:-1]) > 0) for x in held]


def _alike(order: list[int], shares: list[int], least: int) -> Iterator[list[tuple[int, int]]]:
    """Runs of the order that share at least so much with their neighbour; the place and its share with the one before."""
    group: list[tuple[int, int]] = []
    for x, share in zip(order, shares):
        if share < least:
            if len(group) > 1:
                yield group
            group = []
        group.append((x, share))
    if len(group) > 1:
        yield group


def _reach(shares: np.ndarray, rank: np.ndarray, i: int) -> np.ndarray:
    """What member i shares with each member, from what neighbours in sorted order share."""
    at = rank[i]
    out = np.empty(len(shares), np.int64)
    out[at] = 2**31
    out[at + 1 :] = np.minimum.accumulate(shares[at + 1 :])
    out[:at] = np.minimum.accumulate(shares[1 : at + 1][::-1])[::-1]
    return out[rank]


def _mark(held: np.ndarray, ahead: int, right: np.ndarray, left: np.ndarray, length: int, own: int) -> None:
    """Windows that begin k bytes before the anchor are shared with who shares k bytes before and the rest after."""
    low, high = np.maximum(length - right, 0), np.minimum(left, ahead)
    low = np.maximum(low, ahead - (len(held) - 2))
    fits = low <= high
    fits[own] = False
    np.add.at(held, ahead - high[fits], 1)
    np.add.at(held, ahead - low[fits] + 1, -1)


def _runs(covered: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


_FOUND = "id binary, low array<int>, high array<int>"


def _sorted_groups(length: int):
    """Goes through regions sorted by gram; holds those of one gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, ids, regions = None, [], []

        def found() -> list[tuple]:
            runs = shared_windows(regions, length) if len(regions) > 1 else []
            return [(i, [a for a, _ in x], [b for _, b in x]) for i, x in zip(ids, runs) if x]

        for batch in batches:
            out = []
            for g, i, ahead, region in zip(*(batch.column(c).to_pylist() for c in ("gram", "id", "ahead", "region"))):
                if g != gram:
                    out += found()
                    gram, ids, regions = g, [], []
                ids.append(i)
                regions.append((ahead, region))
            yield _batch(out, _FOUND)
        yield _batch(found(), _FOUND)

    return run


def _counted_windows(regions: DataFrame, length: int) -> DataFrame:
    """The same result without gathering a gram: parts of the windows that could be equal are counted, then these windows."""
    far = F.octet_length("region") - length  # last window
    block = F.explode(F.sequence(F.floor((F.col("ahead") - far) / BLOCK), F.floor(F.col("ahead") / BLOCK))).alias("block")
    cut = regions.select("gram", "id", "ahead", "region", far.alias("far"), block)
    # All windows that begin k bytes before the anchor, k of one block, hold these bytes.
    core = F.substring("region", (1 + F.col("ahead") - F.col("block") * BLOCK).cast("int"), F.lit(length - BLOCK + 1))
    cut = cut.withColumn("core", F.md5(core))
    often = cut.groupBy("gram", "block", "core").agg(F.count("*").alias("n")).filter("n > 1")
    near = cut.join(often, ["gram", "block", "core"], "left_semi")
    least, most = F.greatest(F.col("block") * BLOCK, F.col("ahead") - F.col("far")), F.least(F.col("block") * BLOCK + BLOCK - 1, F.col("ahead"))
    windows = near.select("gram", "id", "ahead", "region", F.explode(F.sequence(least, most)).alias("k"))
    start = (F.col("ahead") - F.col("k")).cast("int")
    windows = windows.select("gram", "id", "k", start.alias("start"), F.md5(F.substring("region", 1 + start, F.lit(length))).alias("window"))
    twice = windows.groupBy("gram", "k", "window").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    hit = windows.join(twice, ["gram", "k", "window"], "left_semi")
    return hit.groupBy("id").agg(F.sort_array(F.collect_list("start")).alias("low")).select("id", "low", F.col("low").alias("high"))


def without_repeats(docs: DataFrame, length: int = LENGTH, limit: int = LIMIT) -> DataFrame:
    """Columns of ``docs`` but text, plus n_bytes, n_removed, n_spans and kept (the remaining bytes, binary).

    A byte goes if it lies in a string of ``length`` bytes that also begins anywhere else, in the same
    text or another; repeated rows count, overlaps too.  Strings are looked for in the input, so every
    copy goes.  n_spans: maximal runs removed.  A null text is empty; texts shorter than ``length`` stay;
    doc_id is not looked at.  The rest may begin or end within a character.  Columns of the names added
    are replaced.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    prepare(docs.sparkSession)
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "kept")
    texts = docs.filter(F.octet_length("text") >= length).select(text_key().alias("key"), "text")
    grams = stored(texts.mapInArrow(_grams(length), "key binary, grams array<long>, times array<long>").dropDuplicates(["key"]), "repeats-grams")
    each = grams.select("key", F.explode(F.arrays_zip("grams", "times")).alias("x")).select("key", F.col("x.grams").alias("gram"), F.col("x.times").alias("n"))
    often = each.groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1").select("gram")
    wanted = each.join(often, "gram", "left_semi").groupBy("key").agg(F.collect_list("gram").alias("grams"))
    different = texts.groupBy("key").agg(F.any_value("text").alias("text"))
    regions = stored(different.join(wanted, "key").mapInArrow(_regions(length), _REGION), "repeats-regions")
    # Regions that occur twice are repeated wholly; of a gram with several, the others are compared.
    ids = regions.groupBy("gram", "id").agg(F.sum(F.size("starts")).alias("n"), F.any_value(F.octet_length("region") - length).alias("far"))
    ids = stored(ids, "repeats-ids")
    per = ids.groupBy("gram").agg(F.count("*").alias("ids")).filter("ids > 1")
    bodies = regions.groupBy("gram", "id").agg(F.any_value("ahead").alias("ahead"), F.any_value("region").alias("region"))
    compared = bodies.join(per, "gram")
    found = compared.filter(F.col("ids") <= limit).select("gram", "id", "ahead", "region").repartition("gram").sortWithinPartitions("gram")
    found = found.mapInArrow(_sorted_groups(length), _FOUND)
    if not per.filter(F.col("ids") > limit).isEmpty():
        found = found.unionByName(_counted_windows(compared.filter(F.col("ids") > limit), length))
    twice = ids.filter("n > 1").select("id", F.array(F.lit(0)).alias("low"), F.array("far").alias("high"))
    ranges = stored(found.unionByName(twice), "repeats-ranges")
    places = regions.select("key", "id", F.explode("starts").alias("start")).join(ranges, "id")
    absolute = lambda c: F.transform(c, lambda x: x + F.col("start"))
    spans = places.select("key", absolute("low").alias("low"), absolute("high").alias("high"))
    key, low, high, times = free(docs, "key", "low", "high", "copies")
    spans = spans.groupBy("key").agg(F.flatten(F.collect_list("low")).alias(low), F.flatten(F.collect_list("high")).alias(high))
    copies = texts.select("key").groupBy("key").agg(F.count("*").alias(times)).filter(F.col(times) > 1)
    by_key = spans.join(copies, "key", "full").withColumnRenamed("key", key)
    joined = docs.withColumn(key, text_key()).join(by_key, key, "left").drop(key)
    rest = docs.drop("text").schema
    return joined.mapInArrow(_cut(length, rest.names, (low, high, times)), widened(rest, "n_bytes long, n_removed long, n_spans long, kept binary"))


def _cut(length: int, rest: list[str], found: tuple[str, str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, low, high, copies in zip(*(batch.column(c).to_pylist() for c in ("text", *found))):
                raw = (text or "").encode()
                edge = np.zeros(len(raw) + 1, np.int64)
                if copies is not None and copies > 1:
                    edge[0] = 1
                elif low:
                    np.add.at(edge, np.array(low), 1)
                    np.add.at(edge, np.array(high) + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                rows.append((len(raw), len(raw) - len(kept), len(_runs(gone)), kept))
            new = [pa.array(x, t) for x, t in zip(zip(*rows) if rows else [()] * 4, [pa.int64()] * 3 + [pa.binary()])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *new], [*rest, "n_bytes", "n_removed", "n_spans", "kept"])

    return run
