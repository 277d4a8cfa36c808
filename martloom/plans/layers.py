"""Rows of the bronze, silver and gold tables, each a function of the layer below."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.calendar import date_attributes, date_spine
from martloom.operators.lookup import Lookup, lookups
from martloom.operators.quality import quality_filter, rules_for
from martloom.schemas import BRONZE, DIMENSIONS, FACT_SALES, SILVER, TableSpec

# The key given to sales without a promotion and to sales whose promotion is not known.
NO_PROMOTION = -1


@dataclass(frozen=True)
class Star:
    """The gold tables. ``maintained`` states what holds when they are kept by this library: no
    TransactionID repeats in ``fact``."""

    fact: DataFrame
    date: DataFrame
    store: DataFrame
    product: DataFrame
    promotion: DataFrame
    maintained: bool = False


def run_time(run_ts: str | None) -> Column:
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def bronze_rows(delivery: DataFrame, entity: str, run_ts: str | None = None) -> DataFrame:
    """A delivery in its declared types with its load time; columns of the delivery that the
    table does not have stay, for choosing among repeated keys."""
    spec = BRONZE[entity]
    typed = {f.name: F.col(f.name).cast(f.dataType) for f in spec.schema.fields if f.name != spec.stamp}
    return delivery.withColumns(typed | {spec.stamp: run_time(run_ts)})


def silver_rows(bronze: DataFrame, entity: str, run_ts: str | None = None) -> DataFrame:
    passed = quality_filter(bronze, rules_for(entity))
    return passed.withColumn(SILVER[entity].stamp, run_time(run_ts)).select(*SILVER[entity].columns)


def dim_date_rows(silver_sales: DataFrame) -> DataFrame:
    return date_attributes(date_spine(silver_sales, "Date")).orderBy("DateKey")


def dimension_members(silver: DataFrame, entity: str, run_ts: str | None = None) -> DataFrame:
    """Silver rows in the shape of their dimension, still without surrogate key."""
    spec: TableSpec = DIMENSIONS[entity]
    return silver.withColumn(spec.stamp, run_time(run_ts)).select(
        *(c for c in spec.columns if c != spec.surrogate)
    )


def fact_rows(
    silver_sales: DataFrame,
    store: DataFrame,
    product: DataFrame,
    promotion: DataFrame,
    date: DataFrame,
    run_ts: str | None = None,
) -> DataFrame:
    """Sales with the surrogate keys of their store, product, promotion and day."""
    found = lookups(
        silver_sales,
        [
            Lookup(store, "StoreID", ["StoreKey"]),
            Lookup(product, "ProductID", ["ProductKey"]),
            Lookup(promotion, "PromotionID", ["PromotionKey"]),
            Lookup(date, "Date", ["DateKey"]),
        ],
        spread_by="TransactionID",
    )
    return found.withColumns(
        {
            "PromotionKey": F.coalesce("PromotionKey", F.lit(NO_PROMOTION)),
            FACT_SALES.stamp: run_time(run_ts),
        }
    ).select(*FACT_SALES.columns)


def star_rows(star: Star) -> DataFrame:
    """Every sale with a describing column of each of its dimensions."""
    rows = lookups(
        star.fact,
        [
            Lookup(star.date, "DateKey", ["Date"]),
            Lookup(star.store, "StoreKey", ["StoreName"]),
            Lookup(star.product, "ProductKey", ["ProductName"]),
            Lookup(star.promotion, "PromotionKey", ["PromotionType"]),
        ],
        spread_by="TransactionID",
    )
    return rows.select(
        "TransactionID", "Date", "StoreName", "ProductName", "PromotionType", "Quantity", "TotalSales"
    )


def star_check(star: Star, rows: int = 10) -> DataFrame:
    """The first sales by ID, for a look at whether the keys find their dimensions.

    A lookup keeps every sale once, so the sales are chosen before it.
    """
    first = star.fact.orderBy("TransactionID").limit(rows)
    return star_rows(replace(star, fact=first)).orderBy("TransactionID")
