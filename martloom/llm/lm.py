"""A Katz backoff bigram model over all training texts, and the log probability of every text under it.

Words are taken as 64-bit hashes; every text ends with one end token and its first token follows a
start mark.  Good-Turing discounts apply to counts up to ``KEEP``.  A bigram seen in training, be it once,
has its discounted relative frequency; what a history leaves over goes to all other tokens, in
proportion to their unigram probability, so that each history's probabilities add up to 1 over all
known tokens and one unknown:

    p(w | h) = scale(h) * d(c) * c / c(h)          if c = c(h, w) >= CUT
               alpha(h) * p(w)                     otherwise
    p(w)     = d1(c) * c / N, or what is left over if w is unknown

Counting and lookup work on blocks of about a million tokens.  A block sends its different bigrams, as
packed arrays in sorted order, to the parts of the bigram table they belong to, and gets back their
counts in the same order; so it does with its words.  Bigrams of one history are in one part, those of
frequent histories in several, dealt by the second word.  A bigram that is common in the corpus reaches
a part once for each block.  The part names one of these blocks as the bigram's owner; what the seen
bigrams of a history take together is summed from the owners, so no table of bigrams is written.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from martloom.llm.arrow import mix64, words
from martloom.llm.scratch import free, prepare, scratch_path, stored, widened

_U = np.uint64
START, END = _U(0x5BF03635F0935AD1), _U(0x1F83D9ABFB41BD6B)
#: Counts above this are not discounted; bigrams seen less often than CUT, so never, are left to the backoff.
KEEP, CUT = 5, 1
#: Bytes of text in a block; different bigrams meant for a part.
BLOCK_BYTES, PART = 6 << 20, 1 << 20
#: Words with more than this share of all tokens have their bigrams dealt among several parts; so there
#: are fewer than 65,536 such words, whatever the corpus.
HOT = 1 / 65_536


@dataclass
class Constants:
    n_tokens: int
    n_words: int
    unigrams: list[float]
    bigrams: list[float]
    unknown: float
    parts: _Parts


@dataclass
class Model:
    """``words``: w, c, alpha, scale.  Words are given by their hash."""

    constants: Constants
    words: DataFrame


def good_turing(counts: dict[int, int], least: int = 1) -> list[float]:
    """Discount factors for counts 1 to KEEP from how many types have each count; 1 where the counts give none.

    ``least``: smaller counts are not used and need no factor.
    """
    n = [counts.get(r, 0) for r in range(KEEP + 2)]
    cut = (KEEP + 1) * n[KEEP + 1] / n[1] if n[1] else 1.0
    factors = []
    for r in range(1, KEEP + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut < 1 else 1.0
        factors.append(d if 0 < d <= 1 and r >= least else 1.0)
    return factors


def unigram_model(n_tokens: int, counts: dict[int, int]) -> tuple[list[float], float]:
    """Discounts of single tokens and what they leave to an unknown one, at least 1 / (N + 1)."""
    d = good_turing(counts)
    left = sum((1 - d[r - 1]) * r * counts.get(r, 0) for r in range(1, KEEP + 1)) / max(n_tokens, 1)
    if left * (n_tokens + 1) >= 1:
        return d, left
    return [n_tokens / (n_tokens + 1)] * (KEEP + 1), 1 / (n_tokens + 1)  # the last for all larger counts


def _squeezed(x: np.ndarray) -> bytes:
    """Packed small, first bytes first: tables and shuffles hold these by the hundred million."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _spread(packed: bytes, kind: type | np.dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _squeezed_words(known: np.ndarray) -> bytes:
    """Words in order, as steps from one to the next."""
    return _squeezed(np.diff(known, prepend=_U(0)))


def _spread_words(packed: bytes) -> np.ndarray:
    return np.cumsum(_spread(packed, _U), dtype=_U)


def _squeezed_counts(x: np.ndarray) -> bytes:
    """Packed as narrow as they allow; the first byte says how wide."""
    x = x.astype(np.int32) if not len(x) or np.abs(x).max() < 2**31 else x
    return bytes([x.itemsize]) + _squeezed(x)


def _spread_counts(packed: bytes) -> np.ndarray:
    return _spread(packed[1:], np.dtype(f"i{packed[0]}")).astype(np.int64)


def _release(spark: SparkSession) -> None:
    """Shuffle files of finished steps go when the driver's garbage is collected; ask for it."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _blocks(docs: DataFrame) -> DataFrame:
    """Texts as numbers of the block's own sorted words; ``docs``: fields to keep, train, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= BLOCK_BYTES:
                yield _packed(held, number)
                number, held, size = number + 1, [], 0
        if held:
            yield _packed(held, number)

    fields = [StructField("block", LongType()), StructField("docs", ArrayType(docs.drop("train", "text").schema))]
    return docs.mapInArrow(run, widened(StructType(fields), "lengths binary, train binary, words binary, tokens binary"))


def _packed(batches: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    column = table.column("text").combine_chunks()
    found = words(pc.ascii_lower(column.cast(pa.large_string())))
    n = table.num_rows
    lengths = np.diff(found.first) + 1
    ends = np.cumsum(lengths) - 1
    tokens = np.full(int(lengths.sum()), END)
    inside = np.ones(len(tokens), bool)
    inside[ends] = False
    tokens[inside] = found.hash
    known = np.unique(np.concatenate([tokens, np.array([START, END], _U)]))
    numbers = np.searchsorted(known, tokens).astype(np.uint32)
    kept = table.drop_columns(["train", "text"])
    docs = pa.StructArray.from_arrays([c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in kept.columns], kept.column_names)
    train = table.column("train").to_numpy(zero_copy_only=False).astype(bool)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), docs),
            *(pa.array([x], pa.binary()) for x in (lengths.astype(np.int32).tobytes(), train.tobytes(), _squeezed_words(known), _squeezed(numbers))),
        ],
        ["block", "docs", "lengths", "train", "words", "tokens"],
    )


@dataclass
class _Block:
    """A block unpacked: its words, tokens, and for each token the one before."""

    words: np.ndarray
    tokens: np.ndarray
    before: np.ndarray
    lengths: np.ndarray
    train: np.ndarray

    @classmethod
    def of(cls, lengths: bytes, train: bytes, words_: bytes, tokens: bytes) -> _Block:
        known, size = _spread_words(words_), np.frombuffer(lengths, np.int32).astype(np.int64)
        token = _spread(tokens, np.uint32).astype(np.int64)
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[np.cumsum(size) - size] = np.searchsorted(known, START)
        return cls(known, token, before, size, np.repeat(np.frombuffer(train, bool), size))

    def bigrams(self, parts: _Parts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different bigrams in order of part, first and second word: code, part, count in training; then each token's place."""
        code = self.before * len(self.words) + self.tokens
        different, place = np.unique(code, return_inverse=True)
        count = np.bincount(place, self.train, minlength=len(different)).astype(np.int64)
        part = parts.of(self.words[different // len(self.words)], self.words[different % len(self.words)])
        turn = np.argsort(part, kind="stable")
        back = np.empty_like(turn)
        back[turn] = np.arange(len(turn))
        return different[turn], part[turn], count[turn], back[place]


@dataclass
class _Parts:
    """To which part of the bigram table a bigram belongs."""

    bits: int
    hot: np.ndarray
    first: np.ndarray
    split: np.ndarray

    def of(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        part = top_bits(h, self.bits)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)
            own = self.hot[at] == h
            dealt = self.first[at] + (mix64(w) % self.split[at].astype(_U)).astype(np.int64)
            part = np.where(own, dealt, part)
        return part


def top_bits(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(x), np.int64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


_PACKED = ("lengths", "train", "words", "tokens")


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column("block")[i].as_py(), _Block.of(*(batch.column(c)[i].as_py() for c in _PACKED))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, block in _each_block(batches):
        count = np.bincount(block.tokens[block.train], minlength=len(block.words))
        begun = int(block.train[np.cumsum(block.lengths) - block.lengths].sum()) if len(block.lengths) else 0
        count[np.searchsorted(block.words, START)] = begun  # how many texts begin: the count of a history, not of a token
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([_signed(block.words[seen]), pa.array(count[seen], pa.int64())], ["w", "c"])


def _ask_bigrams(parts: _Parts):
    """Rows for each block and part: first words and how many bigrams each has, second words, counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in _each_block(batches):
            code, part, count, _ = block.bigrams(parts)
            n, rows = len(block.words), []
            for low, high in _groups(part):
                h = code[low:high] // n
                new = np.flatnonzero(np.diff(h, prepend=-1))
                times = np.diff(np.append(new, len(h))).astype(np.int32)
                seen = count[low:high]
                h_words, w_words = block.words[h[new]].tobytes(), block.words[code[low:high] % n].tobytes()
                rows.append((int(part[low]), number, h_words, _squeezed(times), w_words, _squeezed_counts(seen)))
            yield _rows(rows, ("part", "block", "h", "n", "w", "c"))

    return run


def _groups(part: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(part, prepend=-1))
    return list(zip(edge.tolist(), [*edge[1:].tolist(), len(part)]))


def _rows(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64() if n in ("part", "block") else pa.binary()) for n, x in zip(names, columns)], list(names))


_COUNTED = "block long, part long, counts binary, kinds array<long>"


def _count_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Goes through requests sorted by part; answers each, and tells how many bigrams have each count up to KEEP + 1.

    Counts are negative in the answer to the block that owns the bigram.
    """
    part, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "h", "n", "w", "c"))):
            if row[0] != part:
                if held:
                    yield from _counted_part(part, held)
                part, held = row[0], []
            held.append(row[1:])
    if held:
        yield from _counted_part(part, held)


def _counted_part(part: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
    blocks = [x[0] for x in held]
    h = np.concatenate([np.repeat(np.frombuffer(x[1], _U), _spread(x[2], np.int32)) for x in held])
    w = np.concatenate([np.frombuffer(x[3], _U) for x in held])
    c = np.concatenate([_spread_counts(x[4]) for x in held])
    sizes = np.array([len(x[3]) // 8 for x in held])
    order = np.lexsort((w, h))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1])
    first = np.flatnonzero(new)
    total = np.add.reduceat(c[order], first)
    answer = np.empty(len(order), np.int64)
    answer[order] = np.repeat(total, np.diff(np.append(first, len(order))))
    answer[order[first]] *= -1
    for number, x in zip(blocks, np.split(answer, np.cumsum(sizes)[:-1])):
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([part], pa.int64()), pa.array([_squeezed_counts(x)], pa.binary()), pa.nulls(1, pa.list_(pa.int64()))],
            ["block", "part", "counts", "kinds"],
        )
    kinds = np.bincount(np.minimum(total, KEEP + 2), minlength=KEEP + 3)[: KEEP + 2].astype(np.int64)
    yield pa.RecordBatch.from_arrays(
        [*[pa.nulls(1, pa.int64())] * 2, pa.nulls(1, pa.binary()), pa.array([kinds.tolist()], pa.list_(pa.int64()))], ["block", "part", "counts", "kinds"]
    )


def _sum_histories(unigrams: list[float], pairs: list[float], n_tokens: int, parts: _Parts):
    """For each block and history, over the bigrams the block owns: their discounted counts, and their second words' probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, told, counts in _answered(batches):
            c = _joined([x["c"] for x in told], np.int64)
            code, _, _, _ = block.bigrams(parts)
            seen = -_joined_counts(counts)
            own = seen >= CUT
            seen, h, w = seen[own], code[own] // len(block.words), code[own] % len(block.words)
            mass = np.bincount(h, seen * _factors(seen, pairs), minlength=len(block.words))
            p = np.bincount(h, c[w] * _factors(c[w], unigrams) / max(n_tokens, 1), minlength=len(block.words))
            at = np.flatnonzero(mass)
            yield pa.RecordBatch.from_arrays([_signed(block.words[at]), pa.array(mass[at], pa.float64()), pa.array(p[at], pa.float64())], ["h", "mass", "p"])

    return run


def _ask_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                known = _spread_words(batch.column("words")[i].as_py())
                part, number = top_bits(known, bits), batch.column("block")[i].as_py()
                rows = [(int(part[a]), number, known[a:b].tobytes()) for a, b in _groups(part)]
                yield _rows(rows, ("part", "block", "words"))

    return run


#: What blocks are told of their words: first their counts, then what histories leave over.
_TYPES = {"c": np.int64, "alpha": float, "scale": float}
_ELSE = {"c": 0, "alpha": 1.0, "scale": 1.0}


def _binary(names: Iterable[str]) -> str:
    return ", ".join(f"{x} binary" for x in names)


def _tell_words(names: tuple[str, ...]):
    """Goes through rows sorted by part, the table's words before the blocks' requests.

    The table's words come packed, too, a batch at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, table, ready = None, [], None
        kinds = (_U, *(_TYPES[x] for x in names))
        for batch in batches:
            for at, number, asked, *values in zip(*(batch.column(x).to_pylist() for x in ("part", "block", "words", *names))):
                if at != part:
                    part, table, ready = at, [], None
                if number is None:
                    table.append([np.frombuffer(x, t) for x, t in zip((asked, *values), kinds)])
                    continue
                if ready is None:
                    ready = [np.concatenate(x) for x in zip(*table)] if table else [np.zeros(0, t) for t in kinds]
                    turn = np.argsort(ready[0])
                    ready = [x[turn] for x in ready]
                mine = np.frombuffer(asked, _U)
                if len(ready[0]):
                    place = np.minimum(np.searchsorted(ready[0], mine), len(ready[0]) - 1)
                    hit = ready[0][place] == mine
                    found = [np.where(hit, x[place], _ELSE[n]) for n, x in zip(names, ready[1:])]
                else:
                    found = [np.full(len(mine), _ELSE[n], _TYPES[n]) for n in names]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([at], pa.int64()), *(pa.array([_squeezed(x)]) for x in found)], ["block", "part", *names])

    return run


def _pack_words(bits: int, names: tuple[str, ...]):
    """Words of the table, packed by part, as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = batch.column("w").to_numpy().view(_U)
            values = [batch.column(x).to_numpy() for x in names]
            part = top_bits(w, bits)
            turn = np.argsort(part, kind="stable")
            rows = [(int(part[turn[a]]), None, *(x[turn[a:b]].tobytes() for x in (w, *values))) for a, b in _groups(part[turn])]
            yield _rows(rows, ("part", "block", "words", *names))

    return run


def _told(packed: DataFrame, table: DataFrame, bits: int, names: tuple[str, ...]) -> DataFrame:
    """What ``table`` has of the words of each block, in the order of the block."""
    spark = packed.sparkSession
    requests = packed.select("block", "words").mapInArrow(_ask_words(bits), "part long, block long, words binary")
    rows = table.select("w", *names).mapInArrow(_pack_words(bits, names), f"part long, block long, words binary, {_binary(names)}")
    both = rows.unionByName(requests, allowMissingColumns=True).repartition("part").sortWithinPartitions("part", F.asc_nulls_first("block"))
    path, schema = scratch_path(spark, "lm-told"), f"block long, part long, {_binary(names)}"
    both.mapInArrow(_tell_words(names), schema).write.option("compression", "zstd").parquet(path)
    _release(spark)
    return spark.read.schema(schema).parquet(path)


def _together(blocks: DataFrame, counted: DataFrame, *told: DataFrame) -> DataFrame:
    """Each block's answers, then the block."""
    rows = blocks.withColumn("kind", F.lit(0))
    for kind, more in enumerate((counted, *told), 1):
        rows = rows.unionByName(more.withColumn("kind", F.lit(kind)), allowMissingColumns=True)
    return rows.repartition("block").sortWithinPartitions("block", F.desc("kind"), "part")


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Block, pa.Array | None, list[dict], list[bytes]]]:
    """Each block with its documents, if they are there, what it was told of its words, and the counts of its bigrams."""
    told, counts = [], []
    for batch in batches:
        names, about = set(batch.schema.names), [x for x in _TYPES if x in batch.schema.names]
        for i in range(batch.num_rows):
            kind = batch.column("kind")[i].as_py()
            if kind > 1:
                told.append({x: v for x in about if (v := batch.column(x)[i].as_py()) is not None})
            elif kind == 1:
                counts.append(batch.column("counts")[i].as_py())
            else:
                block = _Block.of(*(batch.column(c)[i].as_py() for c in _PACKED))
                yield block, batch.column("docs").slice(i, 1).flatten() if "docs" in names else None, told, counts
                told, counts = [], []


def _joined(packed: Iterable[bytes], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(_spread(x, kind) for x in packed)])


def _joined_counts(packed: Iterable[bytes]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *map(_spread_counts, packed)])


def fit(docs: DataFrame) -> tuple[Model, DataFrame, DataFrame, list[DataFrame]]:
    """Learn from the rows of ``docs`` marked train; returns the model, the blocks, and what each block was told."""
    spark = docs.sparkSession
    prepare(spark)
    path = scratch_path(spark, "lm-blocks")
    made = _blocks(docs)
    made.write.option("compression", "zstd").parquet(path)
    blocks = spark.read.schema(made.schema).parquet(path)
    packed = blocks.select("block", *_PACKED)
    start = int(START.astype(np.int64))
    counts = stored(packed.mapInArrow(_word_counts, "w long, c long").groupBy("w").agg(F.sum("c").alias("c")), "lm-words")
    _release(spark)
    tokens = counts.filter(F.col("w") != start)
    small = [F.count(F.when(F.col("c") == r, 1)).alias(f"n{r}") for r in range(1, KEEP + 2)]
    total = tokens.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), *small).first()
    unigrams, unknown = unigram_model(total.n, {r: total[f"n{r}"] for r in range(1, KEEP + 2)})
    bits = max(0, math.ceil(math.log2(max(total.n, 1) / PART)))
    often = counts.filter(F.col("c") > F.lit(total.n * HOT)).filter(F.col("c") > PART).orderBy("w").toPandas()
    hot = often["w"].to_numpy(np.int64).view(_U)
    split = np.maximum(1, -(-often["c"].to_numpy(np.int64) // PART))
    turn = np.argsort(hot)
    parts = _Parts(bits, hot[turn], 2**bits + np.cumsum(split[turn]) - split[turn], split[turn])
    asked = packed.mapInArrow(_ask_bigrams(parts), "part long, block long, h binary, n binary, w binary, c binary")
    asked = asked.repartition("part").sortWithinPartitions("part")
    path = scratch_path(spark, "lm-bigrams")
    asked.mapInArrow(_count_bigrams, _COUNTED).write.option("compression", "zstd").parquet(path)
    counted = spark.read.schema(_COUNTED).parquet(path)
    _release(spark)
    kinds = counted.filter("kinds IS NOT NULL").agg(*(F.coalesce(F.sum(F.col("kinds")[r]), F.lit(0)) for r in range(KEEP + 2))).first()
    pairs = good_turing(dict(enumerate(kinds)), CUT)
    answers = counted.filter("counts IS NOT NULL").select("block", "part", "counts")
    seen = _told(packed, counts, bits, ("c",))
    owned = _together(packed, answers, seen).mapInArrow(_sum_histories(unigrams, pairs, total.n, parts), "h long, mass double, p double")
    sums = owned.groupBy("h").agg(F.sum("mass").alias("mass"), F.sum("p").alias("p"))
    share = F.col("mass") / F.col("c")
    most = F.col("c") / (F.col("c") + 1)  # a history always leaves something for what it was not seen with
    scale = F.when(share > most, most / share).otherwise(1.0)
    known = counts.join(sums.withColumnRenamed("h", "w"), "w", "left").withColumn("scale", F.coalesce(scale, F.lit(1.0)))
    alpha = F.coalesce((1 - F.col("scale") * share) / (1 - F.col("p")), F.lit(1.0))
    table = stored(known.select("w", "c", alpha.alias("alpha"), "scale"), "lm-table")
    _release(spark)
    left = _told(packed, table, bits, ("alpha", "scale"))
    model = Model(Constants(total.n, total.v, unigrams, pairs, unknown, parts), table)
    return model, blocks, answers, [seen, left]


def scored(docs: DataFrame, train: Column) -> DataFrame:
    """Columns of ``docs`` but text, plus n_tokens, n_known, train_tokens, base_score and score.

    The model learns from the texts of rows for which ``train`` holds (null: not), and scores all.
    score: log10 of the text's probability; base_score: the same with each token's add-one unigram
    probability; n_known: tokens, repeats counted, that occur in training.  A null text is empty and has
    its end token alone.  Without training texts every token is unknown, with probability 1.  Columns of
    the names added are replaced.
    """
    added = "n_tokens long, n_known long, train_tokens long, base_score double, score double"
    docs = _with_field(docs.drop(*[x.split()[0] for x in added.split(", ")]))
    own = next((c for c in docs.columns if c.lower() == "train"), "train")
    flag, kept = free(docs, "flag", "train")  # a column of the input may be called as the mark is
    rows = docs.withColumns({flag: F.coalesce(train, F.lit(False)), "text": F.coalesce("text", F.lit(""))})
    rows = rows.withColumnRenamed(own, kept).withColumnRenamed(flag, "train")
    model, blocks, counted, told = fit(rows)
    together = _together(blocks, counted, *told)
    fields = rows.drop("train", "text").schema
    return together.mapInArrow(_score(model.constants), widened(fields, added)).withColumnRenamed(kept, own).drop(_NONE)


def _with_field(docs: DataFrame) -> DataFrame:
    """A block's documents are records of the fields beside text, of which there must be one."""
    return docs.withColumn(_NONE, F.lit(0)) if docs.columns == ["text"] else docs


_NONE = "no field but text"


def _factors(c: np.ndarray, factors: list[float]) -> np.ndarray:
    table = np.array([1.0, *factors, 1.0][: KEEP + 2]) if len(factors) <= KEEP else np.array([1.0, *factors])
    return table[np.minimum(c, KEEP + 1)]


def _score(constants: Constants):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, docs, told, counts in _answered(batches):
            yield _scores(block, docs, told, counts, constants)

    return run


def _scores(block: _Block, docs: pa.StructArray, told: list, counts: list, model: Constants) -> pa.RecordBatch:
    pairs = model.bigrams
    c, alpha, scale = (_joined([x[name] for x in told if name in x], kind) for name, kind in _TYPES.items())
    seen = np.abs(_joined_counts(counts))
    as_token, single = _singles(block, c, model)
    pair, h, w = seen[block.bigrams(model.parts)[3]], block.before, block.tokens
    known = np.log10(np.where(pair >= CUT, scale[h] * pair * _factors(pair, pairs) / np.maximum(c[h], 1), 1.0))
    return _summed(block, docs, as_token, np.where(pair >= CUT, known, np.log10(alpha)[h] + single[w]), model)


def _singles(block: _Block, c: np.ndarray, model: Constants) -> tuple[np.ndarray, np.ndarray]:
    """Of each of the block's words: its count as a token, and the log10 of its unigram probability."""
    as_token = c.copy()
    as_token[np.searchsorted(block.words, START)] = 0
    with np.errstate(divide="ignore"):
        p = np.where(as_token > 0, as_token * _factors(as_token, model.unigrams) / max(model.n_tokens, 1), model.unknown)
        return as_token, np.log10(p)


def _summed(block: _Block, docs: pa.StructArray, as_token: np.ndarray, value: np.ndarray, model: Constants) -> pa.RecordBatch:
    """The block's documents with their totals; ``value``: the log10 probability of each token."""
    n, w = model.n_tokens, block.tokens
    base = np.log10((as_token + 1) / (n + model.n_words + 1))
    first = np.cumsum(block.lengths) - block.lengths
    total = lambda x: np.add.reduceat(x, first) if len(first) else np.zeros(0)
    new = [
        pa.array(block.lengths, pa.int64()),
        pa.array(total((as_token[w] > 0).astype(np.int64)), pa.int64()),
        pa.array(np.full(len(first), n), pa.int64()),
        pa.array(total(base[w]), pa.float64()),
        pa.array(total(value), pa.float64()),
    ]
    names = [f.name for f in docs.type]
    return pa.RecordBatch.from_arrays([*docs.flatten(), *new], [*names, "n_tokens", "n_known", "train_tokens", "base_score", "score"])


#: Folders that the stored bigrams of ordinary histories are dealt to, by history.
SLICES = 64
_PAIRS = "part long, h long, w long, p double"
_CONSTANTS = (
    "n_tokens long, n_words long, unigrams array<double>, bigrams array<double>, unknown double, "
    "bits int, hot array<long>, first array<long>, split array<long>"
)


def learn(docs: DataFrame, path: str) -> None:
    """Fit a model to all texts of ``docs`` and write it to ``path``, which must not exist.

    ``bigrams``: every bigram seen in training and its discounted probability, partitioned by history, those of a
    frequent history by second word too.  ``words``: count and backoff weight of each token and history.
    ``constants``: one row.  Words are 64-bit hashes.  A null text is empty.
    """
    spark = docs.sparkSession
    rows = _with_field(docs.select(F.coalesce("text", F.lit("")).alias("text"))).withColumn("train", F.lit(True))
    model, blocks, answers, told = fit(rows)
    k = model.constants
    owned = _together(blocks.select("block", *_PACKED), answers, *told).mapInArrow(_owned_bigrams(k), _PAIRS)
    part, whole = F.col("part"), 2**k.parts.bits
    by_history = F.when(part < whole, F.floor(part * SLICES / whole)).otherwise(F.lit(SLICES))
    sliced = owned.repartition("part").withColumn("slice", by_history.cast("int")).sortWithinPartitions("slice", "part", "h", "w")
    sliced.write.partitionBy("slice").option("compression", "zstd").parquet(f"{path}/bigrams")
    model.words.select("w", "c", "alpha").write.parquet(f"{path}/words")
    listed = [x.view(np.int64).tolist() for x in (k.parts.hot, k.parts.first, k.parts.split)]
    row = (k.n_tokens, k.n_words, k.unigrams, k.bigrams, k.unknown, k.parts.bits, *listed)
    spark.createDataFrame([row], _CONSTANTS).write.parquet(f"{path}/constants")


def _owned_bigrams(model: Constants):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, told, counts in _answered(batches):
            c, _, scale = (_joined([x[name] for x in told if name in x], kind) for name, kind in _TYPES.items())
            code, part, _, _ = block.bigrams(model.parts)
            seen = -_joined_counts(counts)
            own = seen >= CUT
            seen, part, h, w = seen[own], part[own], code[own] // len(block.words), code[own] % len(block.words)
            p = scale[h] * seen * _factors(seen, model.bigrams) / np.maximum(c[h], 1)
            columns = [pa.array(part, pa.int64()), _signed(block.words[h]), _signed(block.words[w]), pa.array(p, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "h", "w", "p"])

    return run


class Stored:
    """A model read from the tables that ``learn`` wrote."""

    def __init__(self, spark: SparkSession, path: str):
        row = spark.read.parquet(f"{path}/constants").first()
        hot, first, split = (np.array(row[x], np.int64) for x in ("hot", "first", "split"))
        parts = _Parts(row.bits, hot.view(_U), first, split)
        self.constants = Constants(row.n_tokens, row.n_words, row.unigrams, row.bigrams, row.unknown, parts)
        self.words = spark.read.schema("w long, c long, alpha double").parquet(f"{path}/words")
        self.bigrams = spark.read.schema(f"{_PAIRS}, slice int").parquet(f"{path}/bigrams")

    def scored(self, docs: DataFrame) -> DataFrame:
        """Columns of ``docs`` but text, and those that the function ``scored`` adds, for texts the model need not know.

        The probability of each token is looked up, that of its bigram first; a bigram the table lacks backs
        off to the weight of the history times the token's own probability, and a token it lacks is unknown.
        Different bigrams and words of a block are asked for once; the table is read once.
        """
        added = "n_tokens long, n_known long, train_tokens long, base_score double, score double"
        docs = _with_field(docs.drop(*[x.split()[0] for x in added.split(", ")]))
        spark = docs.sparkSession
        prepare(spark)
        own = next((c for c in docs.columns if c.lower() == "train"), "train")
        (kept,) = free(docs, "train")
        rows = docs.withColumnRenamed(own, kept).withColumns({"text": F.coalesce("text", F.lit("")), "train": F.lit(False)})
        made, path = _blocks(rows), scratch_path(spark, "lm-asked")
        made.write.option("compression", "zstd").parquet(path)
        blocks = spark.read.schema(made.schema).parquet(path)
        packed = blocks.select("block", *_PACKED)
        asked = packed.mapInArrow(_ask_bigrams(self.constants.parts), "part long, block long, h binary, n binary, w binary, c binary").drop("c")
        table = self.bigrams.select("part", "h", "w", "p").mapInArrow(_pack_bigrams, "part long, block long, h binary, w binary, p binary")
        both = table.unionByName(asked, allowMissingColumns=True).repartition("part")
        both = both.sortWithinPartitions("part", F.asc_nulls_first("block")).select("part", "block", "h", "n", "w", "p")
        answers = both.mapInArrow(_tell_bigrams, "block long, part long, counts binary")
        words_ = _told(packed, self.words, self.constants.parts.bits, ("c", "alpha"))
        fields = rows.drop("train", "text").schema
        found = _together(blocks, answers, words_).mapInArrow(_evaluate(self.constants), widened(fields, added))
        return found.withColumnRenamed(kept, own).drop(_NONE)


def _pack_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        part = batch.column("part").to_numpy()
        turn = np.argsort(part, kind="stable")
        h, w, p = (batch.column(x).to_numpy()[turn] for x in ("h", "w", "p"))
        rows = [(int(part[turn[a]]), None, h[a:b].tobytes(), w[a:b].tobytes(), p[a:b].tobytes()) for a, b in _groups(part[turn])]
        yield _rows(rows, ("part", "block", "h", "w", "p"))


def _tell_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Goes through rows sorted by part, the table's bigrams before the blocks' requests; 0 for what the table lacks."""
    part, table, ready = None, [], None
    for batch in batches:
        for at, number, h, n, w, p in zip(*(batch.column(x).to_pylist() for x in ("part", "block", "h", "n", "w", "p"))):
            if at != part:
                part, table, ready = at, [], None
            if number is None:
                table.append((np.frombuffer(h, _U), np.frombuffer(w, _U), np.frombuffer(p, float)))
                continue
            ready = ready or _Bigrams(table)
            found = ready.of(np.repeat(np.frombuffer(h, _U), _spread(n, np.int32)), np.frombuffer(w, _U))
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([at], pa.int64()), pa.array([_squeezed(found)])], ["block", "part", "counts"])


class _Bigrams:
    """Probabilities of one part's bigrams, by the places of their words among those of the part."""

    def __init__(self, table: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        h, w, p = (np.concatenate(x) for x in zip(*table)) if table else (np.zeros(0, _U), np.zeros(0, _U), np.zeros(0))
        self.h, self.w = np.unique(h), np.unique(w)
        code = np.searchsorted(self.h, h) * len(self.w) + np.searchsorted(self.w, w)
        turn = np.argsort(code)
        self.code, self.p = code[turn], p[turn]

    def of(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        if not len(self.code):
            return np.zeros(len(h))
        (i, has_h), (j, has_w) = _place(self.h, h), _place(self.w, w)
        at, hit = _place(self.code, i * len(self.w) + j)
        return np.where(has_h & has_w & hit, self.p[at], 0.0)


def _place(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value stands among the sorted known ones, and whether it is one of them."""
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return at, known[at] == asked


def _evaluate(model: Constants):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, docs, told, found in _answered(batches):
            c, alpha = (_joined([x[name] for x in told if name in x], _TYPES[name]) for name in ("c", "alpha"))
            as_token, single = _singles(block, c, model)
            p = _joined(found, float)[block.bigrams(model.parts)[3]]
            value = np.log10(np.where(p > 0, p, 1.0))
            value = np.where(p > 0, value, np.log10(alpha)[block.before] + single[block.tokens])
            yield _summed(block, docs, as_token, value, model)

    return run
