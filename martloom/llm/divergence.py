"""Source divergence audit: how the word use of the sources of a language differs, term by term.

Terms that count are those in enough documents of their language.  They are found by refining prefixes:
the beginnings of terms, so many bytes long, are counted by the documents they occur in, beginnings in too
few documents are discarded with all terms that start so, and the others are extended to twice the
length, until only complete terms are left.  The long tail of rare terms is never counted term by term.

Texts are cut into terms once; each document's different terms are kept with their counts.  A level is
one pass over these.  What a level kept reaches the tasks of the next as a table of bits at the hashes of
the kept prefixes, of a bounded size: a prefix that meets another one's bit costs work and no result, as
every count is exact and compared with the threshold itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.arrow import mix64, powers, utf8
from martloom.llm.scratch import prepare, stored

_U = np.uint64
#: A term is in the audit if it occurs in so many documents of its language.
LEAST_DOCS = 10
#: Bytes of the first prefixes; each level doubles them.
FIRST = 4
#: Counts that a task adds up before it hands them on.
HELD = 400_000
#: Bits of the table of kept prefixes: 16 for each, and no more than 128 MB.
MOST_BITS = 1 << 30
#: Sources compared with each other at a time, and counts of a language in a part of its terms.
BLOCK, PART = 128, 100_000
#: Shares are whole numbers of this many to the whole.
SCALE = 1_000_000_000

_PART_OF_TERM = np.zeros(256, bool)
_PART_OF_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE = mix64(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))


def document_terms(docs: DataFrame) -> DataFrame:
    """lang, source and the different terms of each row of ``docs``, in lower case.

    ``terms`` holds their bytes, one term after the other, ``sizes`` and ``counts`` how many bytes each has and
    how often it occurs, as 32-bit numbers.
    """
    prepare(docs.sparkSession)
    rows = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *_terms(batch.column("text"))], ["lang", "source", "terms", "sizes", "counts"])

    return rows.mapInArrow(run, "lang string, source string, terms binary, sizes binary, counts binary")


def _terms(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    data, at = utf8(texts)
    data = _LOWER[data]
    solid = np.concatenate([[False], _PART_OF_TERM[data], [False]])
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True  # a term ends with its text
    begins = np.flatnonzero(solid[1:] & (~solid[:-1] | cut))
    ends = np.flatnonzero(solid[:-1] & (~solid[1:] | cut))
    row = np.searchsorted(at, begins, "right") - 1
    found = _binary(data[solid[1:-1]], ends - begins).dictionary_encode()
    known = max(len(found.dictionary), 1)
    key, count = np.unique(row * known + found.indices.to_numpy(), return_counts=True)
    per_row = np.diff(np.searchsorted(key, np.arange(len(at)) * known))
    terms, where = _bytes_of(found.dictionary.take(pa.array(key % known)))
    size = np.diff(where)
    bytes_ = np.diff(where[np.concatenate([[0], np.cumsum(per_row)])])
    numbers = (_binary(x.astype(np.uint32).view(np.uint8), 4 * per_row) for x in (size, count))
    return _binary(terms, bytes_), *numbers


def _numbers(packed: pa.Array) -> np.ndarray:
    return np.ascontiguousarray(_bytes_of(packed)[0]).view(np.uint32).astype(np.int64)


def _binary(data: np.ndarray, size: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def _hashes(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each byte string, the same everywhere."""
    data, at = _bytes_of(values)
    size = np.diff(at)
    total = np.zeros(len(size), _U)
    if len(data):
        place = np.arange(len(data)) - np.repeat(at[:-1], size)
        some = np.flatnonzero(size)
        total[some] = np.add.reduceat(_BYTE[data] * powers(int(size.max()))[place], at[:-1][some])
    return mix64(total + size.astype(_U) * _U(0xA0761D6478BD642F))


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    values = values.cast(pa.large_binary())
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def _places(lang: np.ndarray, prefix: np.ndarray, bits: int) -> np.ndarray:
    """The bit of a prefix in the table, given hashes of both; ``bits`` is a power of two."""
    return mix64(prefix + mix64(lang)) & _U(bits - 1)


_COUNTED = "lang string, source string, prefix binary, complete boolean, docs long, n long"


def _level(shared: Broadcast | None, length: int):
    """Counts of a batch: prefixes of ``length`` bytes by language, and terms that are no longer by source as well.

    ``shared``: the bits of the prefixes kept half that length; terms that were complete there are left out.
    """

    def counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = [batch.column(c).dictionary_encode() for c in ("lang", "source")]
            lang, source = (g.indices.to_numpy().astype(np.int64) for g in groups)
            counts = _numbers(batch.column("counts"))
            row = np.repeat(np.arange(batch.num_rows), pc.binary_length(batch.column("sizes")).to_numpy() // 4)
            found = _binary(_bytes_of(batch.column("terms"))[0], _numbers(batch.column("sizes"))).dictionary_encode()
            known, term = found.dictionary, found.indices.to_numpy().astype(np.int64)
            size = pc.binary_length(known).to_numpy()
            if shared is not None:
                bits = shared.value
                before = _hashes(pc.binary_slice(known, 0, length // 2))
                place = _places(_hashes(groups[0].dictionary.cast(pa.binary()))[lang[row]], before[term], 8 * len(bits))
                held = (bits[(place >> _U(3)).astype(np.int64)] >> (place & _U(7)).astype(np.uint8)) & 1
                live = (size > length // 2)[term] & held.astype(bool)
                row, term, counts = row[live], term[live], counts[live]
            whole = (size <= length)[term]
            if whole.any():
                key, at = np.unique((lang[row[whole]] * len(groups[1].dictionary) + source[row[whole]]) * len(known) + term[whole], return_inverse=True)
                group = key // len(known)
                n = np.bincount(at, counts[whole]).astype(np.int64)
                yield _counted(groups, group // len(groups[1].dictionary), group % len(groups[1].dictionary), known.take(pa.array(key % len(known))), True, np.bincount(at), n)
            if not whole.all():
                cut = pc.binary_slice(known, 0, length).dictionary_encode()
                some, beginnings = len(cut.dictionary), cut.indices.to_numpy().astype(np.int64)
                in_row = np.unique(row[~whole] * some + beginnings[term[~whole]])
                key, docs = np.unique(lang[in_row // some] * some + in_row % some, return_counts=True)
                yield _counted(groups, key // some, None, cut.dictionary.take(pa.array(key % some)), False, docs, np.zeros(len(key), np.int64))

    return lambda batches: _added_up(counts_of(batches))


def _added_up(counted: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same counts, those of a task's batches added up as far as a bounded table of them holds."""
    keys = ["lang", "source", "prefix", "complete"]
    held, rows = [], 0
    for batch in counted:
        held.append(batch)
        rows += batch.num_rows
        if rows >= HELD:
            table = pa.Table.from_batches(held).group_by(keys, use_threads=False).aggregate([("docs", "sum"), ("n", "sum")])
            held, rows = [], 0
            table = table.rename_columns([*keys, "docs", "n"])
            if table.num_rows > HELD // 2:  # too many different ones to hold
                yield from table.to_batches(50_000)
            else:
                held, rows = table.to_batches(), table.num_rows
    if held:
        table = pa.Table.from_batches(held).group_by(keys, use_threads=False).aggregate([("docs", "sum"), ("n", "sum")])
        yield from table.rename_columns([*keys, "docs", "n"]).to_batches(50_000)


def _counted(groups: list, lang: np.ndarray, source: np.ndarray | None, prefix: pa.Array, complete: bool, docs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    size = len(prefix)
    columns = [
        groups[0].dictionary.take(pa.array(lang)),
        pa.nulls(size, pa.string()) if source is None else groups[1].dictionary.take(pa.array(source)),
        prefix,
        pa.array(np.full(size, complete)),
        pa.array(docs.astype(np.int64)),
        pa.array(n),
    ]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _COUNTED.split(", ")])


def kept_counts(terms: DataFrame, least_docs: int = LEAST_DOCS, first: int = FIRST, most_bits: int = MOST_BITS) -> DataFrame:
    """lang, source, term (bytes), n: occurrences of the kept terms, for the sources that have them.

    ``terms``: from ``document_terms``, stored.  One level of prefixes after the other, each by distinct documents.
    """
    spark, length, shared, found = terms.sparkSession, first, None, []
    while True:
        counted = terms.mapInArrow(_level(shared, length), _COUNTED).groupBy("lang", "source", "prefix", "complete")
        counted = stored(counted.agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")), f"divergence-{length}")
        if shared is not None:
            shared.unpersist()
        total = counted.groupBy("lang", "prefix", "complete").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least_docs)
        kept = total.filter("complete").select("lang", "prefix")
        found.append(counted.filter("complete").join(kept, ["lang", "prefix"], "left_semi").select("lang", "source", F.col("prefix").alias("term"), "n"))
        longer = stored(total.filter("NOT complete").select("lang", "prefix"), f"divergence-{length}-kept")
        prefixes = longer.count()
        if not prefixes:
            return reduce(DataFrame.unionByName, found)
        bits = 1 << min(max(15, (16 * prefixes - 1).bit_length()), most_bits.bit_length() - 1)
        shared, length = spark.sparkContext.broadcast(_bit_table(longer, bits)), 2 * length


def _bit_table(prefixes: DataFrame, bits: int) -> np.ndarray:
    """A table with the bits of all prefixes set; at most ``bits`` of them come to the driver, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = _places(_hashes(batch.column("lang").cast(pa.binary())), _hashes(batch.column("prefix")), bits)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64) + 1)], ["place"])  # Spark's buckets begin at 1

    places = prefixes.mapInArrow(run, "place long")
    pieces = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("piece"))
    table = np.zeros(bits // 8, np.uint8)
    for row in pieces.toLocalIterator():
        piece = np.frombuffer(row.piece, np.uint8)
        at = (row.bucket - 1) * len(piece)
        table[at : at + len(piece)] = piece
    return table


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = 10, first: int = FIRST, most_bits: int = MOST_BITS, block: int = BLOCK, part: int = PART) -> DataFrame:
    """lang, source, part, item, value and rank: how far each source is from the others of its language.

    ``docs`` has text, lang and source, further columns are ignored; null ones are ''.  Each row is a document,
    repeated or not.  A group is a source in a language; p is a term's share in it, smoothed by 2 and
    rounded down to parts of SCALE, plus 1, and the measure of two shares is the whole part of (p - q)² / (p + q).
    Part ``pair``: every other source of the language, by the sum of this over all kept terms, 0 if there are none.
    Part ``term``: the ``top`` terms that the source has and uses more than its language does.  Ranks begin
    at 1, the highest value first, ties by the bytes of the item.  An empty table gives no rows.
    """
    terms = stored(document_terms(docs), "divergence-terms")
    counts = stored(kept_counts(terms, least_docs, first, most_bits), "divergence-counts")
    groups = terms.select("lang", "source").distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    of_terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    of_langs = of_terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    sized = groups.join(totals, ["lang", "source"], "left").join(of_langs, "lang", "left").na.fill(0)
    places = stored(sized.withColumn("place", number.cast("long")), "divergence-groups")
    return _term_rows(counts, of_terms, places, top).unionByName(_pair_rows(counts, places, block, part))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """Exact beyond 64 bits: counts times SCALE are decimals.  Without kept terms, of no meaning."""
    above = (n.cast("decimal(19,0)") + 2) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", above, F.greatest(total + 2 * kept, F.lit(1)).cast("decimal(19,0)")) + 1


def _ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    ranked = ranked if top is None else ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _term_rows(counts: DataFrame, of_terms: DataFrame, places: DataFrame, top: int) -> DataFrame:
    used = counts.join(of_terms, ["lang", "term"]).join(places, ["lang", "source"])
    shares = used.withColumns({"p": _share(F.col("n"), F.col("total"), F.col("kept")), "q": _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))})
    value = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("p") + F.col("q"))
    more = shares.filter("p > q").select("lang", "source", F.col("term").cast("string").alias("item"), value.alias("value"))
    return _ranked(more, "term", top)


def _pair_rows(counts: DataFrame, places: DataFrame, block: int, part: int) -> DataFrame:
    """Sums over all kept terms, for every pair of sources.

    The sources of a language are taken ``block`` at a time, two blocks in a task, with one part of the
    language's terms; the sum over a part is made there.  A term that no source of two blocks has adds the same to
    each pair of them, and is added by number.
    """
    rare = places.withColumn("none", _share(F.lit(0).cast("long"), F.col("total"), F.col("kept")))
    sizes = places.groupBy("lang").agg(
        F.sum("held").alias("rows"), F.count("*").alias("sources"), F.max("kept").alias("terms")
    ).withColumns({"parts": F.ceil(F.greatest("rows", F.lit(1)) / part).cast("long"), "blocks": F.ceil(F.col("sources") / block).cast("long")})
    shares = counts.join(rare.drop("held"), ["lang", "source"]).join(sizes.select("lang", "parts", "blocks"), "lang")
    held = shares.select("lang", "term", "place", "none", _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), F.pmod(F.xxhash64("term"), F.col("parts")).alias("part"), "blocks")
    # Each part also gets every source of its blocks, so that those without a term there are counted too.
    there = rare.join(sizes.select("lang", "parts", "blocks"), "lang").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    there = there.select("lang", F.lit(None).cast("binary").alias("term"), "place", "none", F.col("none").alias("p"), "part", "blocks")
    own = F.floor(F.col("place") / block).cast("long")
    dealt = held.unionByName(there).withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))})
    dealt = dealt.select("lang", "part", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "place", "term", "p", "none")
    sums = dealt.groupBy("lang", "part", "a", "b").applyInArrow(_pairs(block), "lang string, x long, y long, value long, seen long")
    sums = sums.groupBy("lang", "x", "y").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    # Every source beside every other of its language: these are the rows of the result.
    one = rare.select("lang", "source", F.col("place").alias("x"), F.col("none").alias("x_none"), "kept")
    other = rare.select("lang", F.col("source").alias("item"), F.col("place").alias("y"), F.col("none").alias("y_none"))
    pairs = one.join(other, "lang").filter("x <> y").join(sums, ["lang", "x", "y"], "left")
    apart = F.col("x_none") - F.col("y_none")
    rest = (F.col("kept") - F.coalesce("seen", F.lit(0))) * F.call_function("div", apart * apart, F.col("x_none") + F.col("y_none"))
    value = F.coalesce("value", F.lit(0)) + F.when(F.col("kept") > 0, rest).otherwise(0)
    return _ranked(pairs.select("lang", "source", "item", value.cast("long").alias("value")), "pair")


def _pairs(block: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        place = rows.column("place").to_numpy()
        sources, line = np.unique(place, return_inverse=True)
        none = np.zeros(len(sources), np.int64)
        none[line] = rows.column("none").to_numpy()
        real = rows.column("term").is_valid().to_numpy()
        term = rows.column("term").filter(pa.array(real)).combine_chunks().dictionary_encode().indices.to_numpy()
        line, p = line[real], rows.column("p").to_numpy()[real]
        order = np.argsort(term, kind="stable")
        line, term, p = line[order], term[order], p[order]
        kinds = int(term[-1]) + 1 if len(term) else 0
        left, right = (np.flatnonzero(sources // block == key[i].as_py()) for i in (2, 3))
        total = np.zeros((len(left), len(right)), np.int64)
        step = max(1, (1 << 20) // (len(left) * len(right)))
        for low in range(0, kinds, step):
            high = min(low + step, kinds)
            here = slice(*np.searchsorted(term, [low, high]))
            dense = np.repeat(none[:, None], high - low, 1)
            dense[line[here], term[here] - low] = p[here]
            a, b = dense[left][:, None, :], dense[right][None, :, :]
            total += ((a - b) * (a - b) // (a + b)).sum(2)
        x, y = np.repeat(sources[left], len(right)), np.tile(sources[right], len(left))
        values = total.ravel()
        if key[2] != key[3]:
            x, y, values = np.concatenate([x, y]), np.concatenate([y, x]), np.tile(values, 2)
        columns = [pa.array([key[0].as_py()] * len(x), pa.string()), pa.array(x), pa.array(y), pa.array(values), pa.array(np.full(len(x), kinds, np.int64))]
        return pa.Table.from_arrays(columns, ["lang", "x", "y", "value", "seen"])

    return run
