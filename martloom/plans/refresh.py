"""One run of the whole chain: deliveries to bronze, silver, gold and the analytics views.

Where the warehouse keeps its sales in parts, a load reads the rows that the layer below changed since
the last one, and writes the parts these rows and their former versions are in.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.keys import scd1_dimension
from martloom.operators.quality import rules_for
from martloom.operators.upsert import conform, one_row_per_key, upsert
from martloom.plans.audit import layer_row_counts
from martloom.plans.layers import (
    Star,
    bronze_rows,
    dim_date_rows,
    dimension_members,
    fact_rows,
    run_time,
    silver_rows,
)
from martloom.plans.views import publish_views
from martloom.schemas import (
    BRONZE,
    DIM_DATE,
    DIM_PRODUCT,
    DIM_PROMOTION,
    DIM_STORE,
    DIMENSIONS,
    ENTITIES,
    FACT_SALES,
    SILVER,
    TableSpec,
)
from martloom.session import bucketed_scans, together, written
from martloom.sources.footers import footers
from martloom.sources.warehouse import LOAD, PART, Warehouse


def load_bronze(
    warehouse: Warehouse,
    entity: str,
    delivery: DataFrame,
    run_ts: str | None = None,
    order_by: Sequence[Column | str] = (),
) -> None:
    """Merge a delivery. A key repeated in it fails the load, unless ``order_by`` says which row
    comes first. Rows without a key stay out; ``rejected_rows`` on the delivery counts them."""
    merge_into(
        warehouse,
        BRONZE[entity],
        bronze_rows(delivery, entity, run_ts),
        on_duplicate="latest" if order_by else "error",
        order_by=order_by,
    )


def load_silver(warehouse: Warehouse, entity: str, run_ts: str | None = None) -> None:
    """Merge the bronze rows that meet the rules; silver rows that stopped meeting them stay.

    The time of validation of all rows that meet the rules is that of the last load.
    """
    if warehouse.in_parts(SILVER[entity]):
        _load_changed_silver(warehouse, entity, run_ts)
        return
    merge_into(warehouse, SILVER[entity], silver_rows(warehouse.read(BRONZE[entity]), entity, run_ts))


def _load_changed_silver(warehouse: Warehouse, entity: str, run_ts: str | None) -> None:
    """Merge what changed in bronze.

    The time of validation is one for all rows that meet the rules, so it is kept once, beside the table.
    Only a row that stopped meeting them gets a time of its own, that of the load before.
    """
    spec = SILVER[entity]
    now = _micros(warehouse, run_ts)
    changed, marks = changed_rows(warehouse, spec, BRONZE[entity])
    own_time = F.lit(None).cast("timestamp")
    source = silver_rows(changed, entity).withColumn(spec.stamp, own_time)
    if warehouse.has_parts(spec):
        met = reduce(Column.__and__, rules_for(entity).values())
        failed = changed.filter(~F.coalesce(met, F.lit(False))).select(spec.key)
        valid = warehouse.rows(spec).filter(F.col(spec.stamp).isNull())
        # Of the table the keys alone are read, and the parts that hold such a row.
        held = valid.select(spec.key, PART).join(failed, spec.key, "left_semi").select(PART).distinct()
        parts = [] if failed.isEmpty() else [r[0] for r in held.collect()]
        if parts:
            stale = valid.filter(F.col(PART).isin(parts)).select(*spec.columns).join(failed, spec.key, "left_semi")
            source = source.unionByName(stale.withColumn(spec.stamp, F.timestamp_micros(F.lit(warehouse.stamp(spec)))))
    merge_parts(warehouse, spec, source, on_duplicate="unique", marks=marks, stamp=now, keys=source)


def load_dim_date(warehouse: Warehouse) -> None:
    """Replace the calendar by the days from the first to the last sale."""
    warehouse.replace(DIM_DATE, dim_date_rows(footers(warehouse.read(SILVER["sales"]))))


def load_dimension(warehouse: Warehouse, entity: str, run_ts: str | None = None) -> None:
    spec = DIMENSIONS[entity]
    members = dimension_members(warehouse.read(SILVER[entity]), entity, run_ts)
    current = warehouse.read(spec) if warehouse.exists(spec) else None
    merged = scd1_dimension(current, members, spec.key, spec.surrogate)
    warehouse.replace(spec, merged.select(*spec.columns))


def load_fact(warehouse: Warehouse, run_ts: str | None = None) -> None:
    """Merge silver sales, so that sales find dimension rows that came after them. A sale
    keeps the time it was first loaded."""
    dims = {spec.label: warehouse.read(spec) for spec in (DIM_STORE, DIM_PRODUCT, DIM_PROMOTION, DIM_DATE)}
    if warehouse.in_parts(FACT_SALES):
        sales, marks = changed_rows(warehouse, FACT_SALES, SILVER["sales"])
        late, newest = _waiting_sales(warehouse, sales)
        facts = fact_rows(late, *dims.values(), run_ts)
        # The day of a sale is the key of its day.
        at = late.select("TransactionID", F.col("Date").alias(FACT_SALES.day))
        merge_parts(warehouse, FACT_SALES, facts, [FACT_SALES.stamp], "unique", marks=marks | newest, keys=at)
        return
    merge_into(warehouse, FACT_SALES, fact_rows(warehouse.read(SILVER["sales"]), *dims.values(), run_ts), preserve=[FACT_SALES.stamp])


def _waiting_sales(warehouse: Warehouse, changed: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """``changed`` with the older sales whose store, product or promotion came since the last load of the
    fact table, and the highest surrogate key of each dimension.

    Keys are given in order, so members that came since have higher ones than any that were there. Without
    new members no older sale is read.
    """
    spec, dims = SILVER["sales"], (DIM_STORE, DIM_PRODUCT, DIM_PROMOTION)
    since, members = warehouse.mark(FACT_SALES, spec.label), {dim.label: warehouse.read(dim) for dim in dims}
    highest = (members[d.label].agg(F.coalesce(F.max(d.surrogate), F.lit(0)).alias("key")).withColumn("dim", F.lit(d.label)) for d in dims)
    newest = {row.dim: row.key for row in reduce(DataFrame.union, highest).collect()}
    last = {dim.label: warehouse.mark(FACT_SALES, dim.label) for dim in dims}
    grown = [dim for dim in dims if 0 <= last[dim.label] < newest[dim.label]]
    if since < 0 or not grown:
        return changed, newest
    older = warehouse.rows(spec).filter(F.col(LOAD) <= since)
    found = older.select(spec.key, PART, *(dim.key for dim in grown))
    for dim in grown:
        fresh = members[dim.label].filter(F.col(dim.surrogate) > last[dim.label])
        found = found.join(fresh.select(dim.key, F.lit(True).alias(f"_{dim.surrogate}")), dim.key, "left")
    found = found.filter(F.coalesce(*(f"_{dim.surrogate}" for dim in grown))).select(spec.key, PART)
    found = written(found, "late-sales")
    parts = [r[0] for r in found.select(PART).distinct().collect()]
    late = older.filter(F.col(PART).isin(parts)).join(found.select(spec.key), spec.key, "left_semi")
    return changed.unionByName(late.select(*changed.columns)), newest


def changed_rows(warehouse: Warehouse, reader: TableSpec, source: TableSpec) -> tuple[DataFrame, dict[str, int]]:
    """Rows of ``source`` written by loads that the last load of ``reader`` has not seen (all before its
    first one), and the mark to keep with the next.

    The load number is a column with a least and a greatest value in the footer of every file, so files of
    parts that no such load wrote are skipped.
    """
    since, seen = warehouse.mark(reader, source.label), warehouse.load(source)
    rows = warehouse.rows(source)
    if since >= 0:
        rows = rows.filter(F.col(LOAD) > since)
    return rows.select(*source.columns), {source.label: seen}


def _micros(warehouse: Warehouse, run_ts: str | None) -> int:
    return warehouse.spark.range(1).select(F.unix_micros(run_time(run_ts))).first()[0]


def refresh(
    warehouse: Warehouse,
    deliveries: Mapping[str, DataFrame],
    run_ts: str | None = None,
    order_by: Mapping[str, Sequence[Column | str]] | None = None,
    run: str | None = None,
) -> DataFrame:
    """Bring every table up to date with a delivery of each entity; returns the row counts.

    Running the same delivery again changes audit columns only. All tables show their new state
    together, after the last one is made: whoever reads meanwhile, or after a failure, finds the star as it
    was. ``run`` names the delivery: a refresh that failed goes on, under the same name, after the
    tables it had made.
    """
    order_by = order_by or {}

    def once(spec: TableSpec, job: Callable[..., None], *arguments) -> None:
        if not warehouse.waits(spec):
            job(warehouse, *arguments)

    def below_fact(entity: str) -> None:
        """The tables of one entity, each from the one before."""
        once(BRONZE[entity], load_bronze, entity, deliveries[entity], run_ts, order_by.get(entity, ()))
        once(SILVER[entity], load_silver, entity, run_ts)
        if entity in DIMENSIONS:
            once(DIMENSIONS[entity], load_dimension, entity, run_ts)
        else:
            once(DIM_DATE, load_dim_date)

    with warehouse.staged(run or uuid.uuid4().hex):
        together(below_fact, ENTITIES)
        once(FACT_SALES, load_fact, run_ts)
    publish_views(warehouse)
    return layer_row_counts(warehouse)


def merge_into(
    warehouse: Warehouse,
    spec: TableSpec,
    source: DataFrame,
    preserve: Sequence[str] = (),
    on_duplicate: str = "error",
    order_by: Sequence[Column | str] = (),
) -> None:
    """Upsert ``source`` into a table of the warehouse.

    The merge reads a bucketed table in its buckets and leaves every row in its bucket. A first
    load is grouped by key as well, but by shuffle partitions, which may be another number. Of a
    table in parts, only those that the merge touches are read and written.
    """
    if warehouse.in_parts(spec):
        merge_parts(warehouse, spec, source, preserve, on_duplicate, order_by)
        return
    if warehouse.exists(spec):
        rows = upsert(
            warehouse.read(spec), source, spec.key, preserve, on_duplicate, order_by, null_keys="drop"
        )
        grouped = warehouse.has_buckets(spec, warehouse.buckets)
    else:
        rows = conform(one_row_per_key(source, spec.key, on_duplicate, order_by), spec.schema)
        grouped = warehouse.spark.conf.get("spark.sql.shuffle.partitions") == str(warehouse.buckets)
    with bucketed_scans(warehouse.spark):
        warehouse.replace(spec, rows, grouped)


def merge_parts(
    warehouse: Warehouse,
    spec: TableSpec,
    source: DataFrame,
    preserve: Sequence[str] = (),
    on_duplicate: str = "error",
    order_by: Sequence[Column | str] = (),
    marks: Mapping[str, int] | None = None,
    stamp: int | None = None,
    keys: DataFrame | None = None,
) -> None:
    """Upsert ``source`` into a table in parts, writing the parts that hold its rows or their former versions.

    Where these are is found by a join of keys, for which only the keys of the table are read. ``keys`` has
    the keys and days of ``source`` where they are had from stored tables for less; otherwise ``source`` is
    written first. A table not yet in parts is written as a whole.

    Where the parts have buckets, those of the table are read one by one and written back as they are.
    """
    if warehouse.part_buckets:
        with bucketed_scans(warehouse.spark):
            _merge_parts(warehouse, spec, source, preserve, on_duplicate, order_by, marks, stamp, keys)
    else:
        _merge_parts(warehouse, spec, source, preserve, on_duplicate, order_by, marks, stamp, keys)


def _merge_parts(
    warehouse: Warehouse,
    spec: TableSpec,
    source: DataFrame,
    preserve: Sequence[str],
    on_duplicate: str,
    order_by: Sequence[Column | str],
    marks: Mapping[str, int] | None,
    stamp: int | None,
    keys: DataFrame | None,
) -> None:
    load = F.lit(warehouse.load(spec) + 1).cast("long")
    came = conform(one_row_per_key(source, spec.key, on_duplicate, order_by), spec.schema).withColumn(LOAD, load)
    if not warehouse.exists(spec):
        warehouse.replace(spec, came, marks=marks, stamp=stamp)
        return
    target = warehouse.rows(spec)
    if not warehouse.has_parts(spec):
        warehouse.replace(spec, upsert(target.drop(PART), came, spec.key, preserve, "unique", null_keys="drop"), marks=marks, stamp=stamp)
        return
    if keys is None:
        keys = came = warehouse.put_down(spec, came) if warehouse.part_buckets else written(came, spec.name)
    former = target.select(spec.key, PART).join(keys.select(spec.key), spec.key, "left_semi").select(PART)
    touched = former.union(keys.select(warehouse.part_of(spec))).distinct()
    parts = [r[0] for r in touched.collect()]  # no more than the table has parts
    old = target.filter(F.col(PART).isin(parts)).drop(PART)
    merged = upsert(old, came, spec.key, preserve, "unique", null_keys="drop")
    warehouse.replace_parts(spec, merged, parts, marks, stamp, grouped=bool(warehouse.part_buckets))


def read_star(warehouse: Warehouse) -> Star:
    """The gold tables of a warehouse."""
    return Star(
        fact=warehouse.read(FACT_SALES),
        date=warehouse.read(DIM_DATE),
        store=warehouse.read(DIM_STORE),
        product=warehouse.read(DIM_PRODUCT),
        promotion=warehouse.read(DIM_PROMOTION),
        maintained=True,
    )
