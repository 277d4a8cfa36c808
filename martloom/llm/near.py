"""Near-duplicate documents by DartMinHash signatures, banded joining and exact verification.

A text is the multiset of its runs of five words; two texts are near duplicates if the weighted
Jaccard similarity of these (sum of the smaller over sum of the larger counts) is at least 0.8.

DartMinHash (Christiani, 2020) throws darts at the plane over each element: they are a Poisson
process with a stream of its own for each element and unit of weight, the same in every text.  A text
is hit by the darts below its weights.  Each dart names one of k coordinates and has a rank; a text's
signature is, for each coordinate, the dart of least rank that hits it.  Two texts share a coordinate
with their weighted Jaccard similarity as probability.  Only darts below a rank of about log(k) * k
over the total weight have to be thrown, so a signature costs time in proportion to the length of
the text plus k log k, not times k.

Texts that share a band of coordinates are candidates.  Links between all of them would grow with the
square of a group of copies, so exact copies count as one text, and each bucket compares its members
with one leader first.  Where texts of one bucket are in different classes after that, all links
between them are still found: two texts that similar must share one of the rarest fifth of their
runs, so only texts that do are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.arrow import mix64, shingles, words
from martloom.llm.components import components
from martloom.llm.scratch import free, prepare, stored

_U = np.uint64
SIZE, SIMILARITY = 5, 0.8
#: 40 bands of 6 coordinates: a pair at similarity 0.8 shares none with probability 6e-6.
BANDS, WIDTH = 40, 6


def text_key(text: str = "text") -> Column:
    return F.unhex(F.md5(F.col(text).cast("binary")))


def elements(texts: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of ``size`` lower-case words of each text, sorted by row and hash: row, hash, count."""
    hashes, rows, _ = shingles(words(pc.utf8_lower(texts)), size)
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    return r[at], h[at], np.diff(np.append(at, len(h)))


def dart_signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, k: int) -> np.ndarray:
    """The winning dart of each coordinate: one line of k hashes for each row, 0s for a row without elements.

    ``weight``: positive numbers.  Units of weight have streams of darts of their own; a dart also has
    a height within its unit, and hits if the weight reaches it, so weights need not be whole.
    """
    units = np.ceil(weight).astype(np.int64)
    of = np.repeat(np.arange(len(row)), units)
    unit = np.arange(len(of)) - np.repeat(np.cumsum(units) - units, units)
    stream, where = mix64(element[of] + mix64(unit + 1)), row[of]
    reach = np.minimum(weight[of] - unit, 1.0)
    total = np.bincount(row, weight, minlength=rows)
    best = np.full(rows * k, np.inf)
    dart = np.zeros(rows * k, _U)
    bound = np.where(total > 0, (k * math.log(k) + 2 * k) / np.maximum(total, 1e-300), 0)
    open_ = total > 0
    while open_.any():
        live = np.flatnonzero(open_[where])
        s, w, far, number = stream[live], where[live], reach[live], 0
        rank = np.zeros(len(live))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(s):  # the next dart of each stream, until its rank leaves the bound
            number += 1
            h = mix64(s + _U(number * 0x9E3779B97F4A7C15 % 2**64))
            rank = rank - np.log(((h >> _U(11)).astype(float) + 1) / 2**53)
            inside = rank < bound[w]
            s, w, far, rank, h = s[inside], w[inside], far[inside], rank[inside], h[inside]
            g = mix64(h ^ _U(0xC2B2AE3D27D4EB4F))
            hits = (g >> _U(11)).astype(float) / 2**53 < far
            coordinate = (mix64(g) % _U(k)).astype(np.int64)[hits]
            found.append((w[hits] * k + coordinate, rank[hits], h[hits]))
        place, ranks, hashes = (np.concatenate(x) for x in zip(*found))
        np.minimum.at(best, place, ranks)
        won = ranks == best[place]
        dart[place[won]] = _U(2**64 - 1)
        np.minimum.at(dart, place[won], hashes[won])  # of equal ranks the least hash
        hit = np.isfinite(best).reshape(rows, k).all(1)
        open_ &= ~hit
        bound = np.where(open_, 2 * bound, bound)  # some coordinate is still without a dart: throw higher
    return dart.reshape(rows, k)


def _bands(bands: int, width: int):
    """Key of a text and its band hashes; no row for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                row, element, count = elements(part.column("text"))
                signature = dart_signatures(row, element, count.astype(float), part.num_rows, bands * width)
                value = np.repeat(np.arange(1, bands + 1, dtype=_U)[None, :], part.num_rows, 0)
                for i in range(width):
                    value = mix64(value + signature.reshape(part.num_rows, bands, width)[:, :, i])
                held = np.flatnonzero(np.bincount(row, minlength=part.num_rows))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(value[held].view(np.int64).ravel()), bands).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(held)), lists], ["key", "bands"])

    return run


def similar_keys(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, width: int = WIDTH) -> DataFrame:
    """Classes of different texts: key (of ``text_key``) and class, the least key; only texts that have a near duplicate.

    Every pair of texts that shares a band either is compared exactly or is already in one class.
    """
    prepare(docs.sparkSession)
    texts = docs.filter("text IS NOT NULL").select(text_key().alias("key"), "text")
    signed = texts.mapInArrow(_bands(bands, width), "key binary, bands array<long>").dropDuplicates(["key"])
    buckets = signed.select("key", F.explode("bands").alias("bucket"))
    # A bucket's leader differs from bucket to bucket, so that groups are held together by many texts.
    first = F.min(F.struct(F.xxhash64("key", "bucket").alias("at"), "key")).getField("key")
    led = buckets.groupBy("bucket").agg(first.alias("leader"), F.count("*").alias("n")).filter("n > 1")
    members = stored(buckets.join(led.select("bucket", "leader"), "bucket"), "near-buckets")
    pairs = members.filter("key <> leader").select(F.least("key", "leader").alias("a"), F.greatest("key", "leader").alias("b")).distinct()
    pairs = stored(pairs, "near-pairs")
    involved = members.select("key").distinct()
    held = stored(texts.join(involved, "key", "left_semi").groupBy("key").agg(F.any_value("text").alias("text")), "near-texts")
    links = stored(_verified(pairs, held, similarity), "near-links")
    classes = stored(components(links), "near-classes")
    # What shares a bucket with another class.
    place = members.select("bucket", "key").join(classes.withColumnRenamed("node", "key"), "key", "left")
    place = place.select("bucket", "key", F.coalesce("class", "key").alias("class"))
    several = place.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    apart = stored(place.join(several, "bucket", "left_semi").select("key", "class").distinct(), "near-apart")
    more = stored(_sharing_rare(held, apart, similarity).join(pairs, ["a", "b"], "left_anti"), "near-more")
    added = stored(_verified(more, held, similarity), "near-added")
    if added.isEmpty():
        return classes.withColumnRenamed("node", "key")
    return stored(components(links.unionByName(added)), "near-classes").withColumnRenamed("node", "key")


def _sharing_rare(texts: DataFrame, apart: DataFrame, similarity: float) -> DataFrame:
    """Pairs of texts of different classes that can be similar enough: none that is gets lost.

    Of n runs, similar texts share at least ``similarity * n``.  In any order of all runs, then, one of
    the first ``n - similarity * n + 1`` of each is shared; the order taken is from rare to common.  At
    the first run that two texts share, what stands before it in either is not shared, and the rest must
    be enough; where it is not, the pair is not formed at that run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, element, count = elements(batch.column("text"))
            of = np.repeat(np.arange(len(row)), count)
            unit = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            size = np.bincount(row, count, minlength=batch.num_rows).astype(np.int64)
            at = pa.array(row[of])
            values = [pa.array(mix64(element[of] + mix64(unit + 1)).view(np.int64)), pa.array(size[row[of]])]
            yield pa.RecordBatch.from_arrays([batch.column("key").take(at), batch.column("class").take(at), *values], ["key", "class", "unit", "size"])

    held = texts.join(apart, "key").select("key", "class", "text")
    units = stored(held.mapInArrow(run, "key binary, class binary, unit long, size long"), "near-units")
    often = units.groupBy("unit").agg(F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
    order = Window.partitionBy("key").orderBy("n", "unit")
    first = F.col("size") - F.ceil(F.col("size") * similarity - 1e-9) + 1
    ranked = units.join(often, "unit").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)
    rare = stored(ranked.filter("low < high").select("unit", F.col("key").alias("a"), "class", "size", (F.col("size") - F.col("rank")).alias("rest")), "near-rare")
    other = rare.toDF("unit", "b", "b_class", "b_size", "b_rest")
    needed = F.ceil((F.col("size") + F.col("b_size")) * (similarity / (1 + similarity)) - 1e-9)
    met = _outsiders(rare).join(other, "unit").filter(F.col("class") != F.col("b_class")).filter(1 + F.least("rest", "b_rest") >= needed)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _outsiders(rare: DataFrame) -> DataFrame:
    """The rows that are not of the class most rows of their run are in.

    Of two rows of different classes one at least is such a row, so these, joined with all rows of their run,
    meet every pair that counts; a cluster with a few outsiders is not joined with itself.
    """
    per = rare.groupBy("unit", "class").agg(F.count("*").alias("n"))
    most = per.groupBy("unit").agg(F.max(F.struct("n", "class")).getField("class").alias("most"))
    return rare.join(most, "unit").filter(F.col("class") != F.col("most")).drop("most")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose exact similarity is high enough."""
    prepare(pairs.sparkSession)
    a, b = (texts.select(F.col("key").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                near = similarities(part.column("text_a"), part.column("text_b")) >= similarity
                yield part.select(["a", "b"]).filter(pa.array(near))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Exact weighted Jaccard similarity of texts, line by line; 0 where neither has words."""
    n = len(left)
    (r1, h1, c1), (r2, h2, c2) = elements(left), elements(right)
    rows, hashes, counts = np.concatenate([r1, r2]), np.concatenate([h1, h2]), np.concatenate([c1, c2])
    order = np.lexsort((hashes, rows))
    r, h, c = rows[order], hashes[order], counts[order]
    same = np.flatnonzero((r[1:] == r[:-1]) & (h[1:] == h[:-1]))
    smaller = np.bincount(r[same], np.minimum(c[same], c[same + 1]), minlength=n)
    return smaller / np.maximum(np.bincount(r, c, minlength=n) - smaller, 1)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id and class_size of each row of ``docs``, which must have doc_id and text.

    ``class_id``: the least doc_id among all rows of the class, ``class_size``: its rows.  A class is
    connected: its texts need not all be that similar to each other.  Equal texts are always in one
    class, also those without words; a row whose text is null is alone.  A class without any doc_id has
    a null class_id.  Repeated rows are rows of their own.
    """
    placed = _classes(docs, similarity).select(F.col("key").alias("_key"), "class_id", "class_size")
    rows = docs.select("doc_id", text_key().alias("_key")).join(placed, "_key", "left")
    alone = F.col("_key").isNull()
    return rows.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1).cast("long")).otherwise(F.col("class_size")).alias("class_size"),
    )


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class of ``docs``, all columns: the least doc_id, and of several such rows the
    least text; rows that agree in both are copies, of which any one stays.  Null texts all stay.
    """
    key, best_key, low = free(docs, "key", "best_key", "low")
    best = _classes(docs, similarity).filter("best").select(F.col("key").alias(best_key), F.col("low").alias(low))
    keyed = docs.withColumn(key, text_key())
    kept = keyed.join(best, (F.col(key) == F.col(best_key)) & F.col("doc_id").eqNullSafe(F.col(low)), "left_semi")
    return kept.dropDuplicates([key]).unionByName(keyed.filter("text IS NULL")).drop(key)


def _classes(docs: DataFrame, similarity: float) -> DataFrame:
    """Each text's key, its least doc_id (low), the class_id and class_size of its class, and whether it stands for it."""
    groups = docs.filter("text IS NOT NULL").groupBy(text_key().alias("key")).agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    classes = similar_keys(docs, similarity).withColumnRenamed("class", "of")
    placed = stored(groups.join(classes, "key", "left").withColumn("of", F.coalesce("of", "key")), "near-groups")
    first = F.min(F.struct(F.col("low").isNull().alias("none"), "low", "key")).getField("key")
    whole = placed.groupBy("of").agg(F.min("low").alias("class_id"), F.sum("n").alias("class_size"), first.alias("first"))
    return placed.join(whole, "of").select("key", "low", "class_id", "class_size", (F.col("first") == F.col("key")).alias("best"))
