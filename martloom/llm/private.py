"""Personal data replaced by surrogates: keyed, of the same kind, and one to one over the whole corpus.

Texts that may hold personal data are searched once.  Each different entity gets a surrogate that
follows from a secret key; two entities with the same surrogate, or one that is itself the value of a
real entity, are told apart by further tries, so that different entities stay different and the same
entity is the same everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.entities import SUSPICIOUS, found, replaced, surrogate
from martloom.llm.scratch import free, prepare, stored, widened

#: Tries for a surrogate that is nobody else's.
TRIES = 40
_ENTITY = "array<struct<kind:string,value:string>>"


def pseudonymised(docs: DataFrame, key: bytes = b"martloom") -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_entities``: how many mentions were replaced.

    Other columns stay; one named n_entities is replaced.  Null texts stay null, texts without personal
    data stay as they are, both with 0.  doc_id may be null or repeat.  Whoever has the key can repeat
    the choice but not reverse it; keep it secret and the same for corpora that belong together.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("n_entities")
    maybe = F.coalesce(F.col("text").rlike(SUSPICIOUS), F.lit(False))
    # Working names that the input does not have.
    entities, row, surrogates = free(docs, "entities", "row", "surrogates")
    searched = docs.filter(maybe).mapInArrow(_search(entities), widened(docs.schema, f"`{entities}` {_ENTITY}"))
    held = stored(searched.withColumn(row, F.monotonically_increasing_id()), "private-texts")
    mentions = held.select(row, F.explode(F.array_distinct(entities)).alias("e")).select(row, "e.kind", "e.value")
    named = assigned(mentions.select("kind", "value").distinct(), key)
    lists = mentions.join(named, ["kind", "value"]).groupBy(row).agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias(surrogates))
    whole = widened(docs.schema, "n_entities long")
    changed = held.filter(F.size(entities) > 0).drop(entities).join(lists, row).drop(row).mapInArrow(_replace(surrogates), whole)
    none = F.lit(0).cast("long").alias("n_entities")
    clean = docs.filter(~maybe).select("*", none).unionByName(held.filter(F.size(entities) == 0).select(*docs.columns, none))
    return clean.unionByName(changed.select(clean.columns))


def assigned(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, value and surrogate: different for each entity of a kind, and the value of none.

    Of entities that meet at a surrogate the first by value keeps it and the others try again. After a few
    tries surrogates of emails, tokens, names and IPv6 addresses grow longer, so that there is always room. Those
    of other kinds keep their length; where it has no room after ``TRIES``, an error names the kind.
    """
    real = stored(entities, "private-entities")
    open_, done, attempt = real, None, 0
    while True:
        tried = open_.mapInArrow(_propose(key, attempt), "kind string, value string, surrogate string")
        order = Window.partitionBy("kind", "surrogate").orderBy("value")
        first = tried.withColumn("_first", F.row_number().over(order) == 1)
        used = real.select("kind", F.col("value").alias("surrogate"))
        if done is not None:
            used = used.union(done.select("kind", "surrogate"))
        marked = first.join(used.distinct().withColumn("_used", F.lit(True)), ["kind", "surrogate"], "left")
        result = stored(marked.select("kind", "value", "surrogate", (F.col("_first") & F.col("_used").isNull()).alias("_ok")), f"private-try-{attempt}")
        good = result.filter("_ok").select("kind", "value", "surrogate")
        done = good if done is None else done.union(good)
        open_ = result.filter("NOT _ok").select("kind", "value")
        if open_.isEmpty():
            return done
        attempt += 1
        if attempt == TRIES:
            kinds = ", ".join(sorted(r.kind for r in open_.select("kind").distinct().collect()))
            raise RuntimeError(f"no surrogates of their own are left for all entities of kind {kinds}")


def _search(name: str):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [[{"kind": e.kind, "value": e.value} for e in found(x)] for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, kind)], [*batch.schema.names, name])

    return run


def _propose(key: bytes, attempt: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("kind").to_pylist(), batch.column("value").to_pylist())
            new = pa.array([surrogate(kind, value, key, attempt) for kind, value in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("value"), new], ["kind", "value", "surrogate"])

    return run


def _replace(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts, counts = [], []
            for text, named in zip(batch.column("text").to_pylist(), batch.column(name).to_pylist()):
                entities = found(text)
                counts.append(len(entities))
                texts.append(replaced(text, entities, {(x["kind"], x["value"]): x["surrogate"] for x in named}))
            batch = batch.drop_columns([name]).set_column(at, "text", pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], [*batch.schema.names, "n_entities"])

    return run
