"""What there is to check after a run: row counts, quality per rule, keys that break their table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.quality import key_violations, quality_counts, rules_for
from martloom.schemas import ENTITY_KEY, TABLES
from martloom.sources.footers import footers
from martloom.sources.warehouse import Warehouse


def layer_row_counts(warehouse: Warehouse) -> DataFrame:
    """Rows of every table of the warehouse, as its files' footers count them."""
    counts = (
        footers(warehouse.read(spec)).agg(F.lit(spec.label).alias("table_name"), F.count("*").alias("row_count"))
        for spec in TABLES
    )
    return reduce(DataFrame.unionByName, counts)


def quality_report(entities: Mapping[str, DataFrame]) -> DataFrame:
    """Rows read, passed and failed, per entity and rule; each entity is read once."""
    counts = (
        quality_counts(rows, rules_for(entity)).select(F.lit(entity).alias("table_name"), "*")
        for entity, rows in entities.items()
    )
    return reduce(DataFrame.unionByName, counts)


def key_report(entities: Mapping[str, DataFrame]) -> DataFrame:
    """Missing and repeated keys, per entity."""
    violations = (
        key_violations(rows, ENTITY_KEY[entity]).select(F.lit(entity).alias("table_name"), "*")
        for entity, rows in entities.items()
    )
    return reduce(DataFrame.unionByName, violations)


def rejected_rows(deliveries: Mapping[str, DataFrame]) -> DataFrame:
    """Rows delivered, and those of them without a key, which stay out of bronze; one scan each."""
    counts = (
        rows.agg(
            F.lit(entity).alias("table_name"),
            F.count("*").alias("delivered_rows"),
            F.count_if(F.col(ENTITY_KEY[entity]).isNull()).alias("rejected_rows"),
        )
        for entity, rows in deliveries.items()
    )
    return reduce(DataFrame.unionByName, counts)
