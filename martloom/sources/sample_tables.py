"""Retail deliveries derived from order-line, part and supplier tables.

Rules on the values of the rows give the deliveries what real ones have: repeated and missing keys,
missing dates and names, returns with negative amounts, promotions without end or without spend, and
sales of promotions, products and stores that never reach their dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The lines shipped before this day come with the first of two deliveries.
SECOND_DELIVERY_FROM = "2000-01-01"
# Part sizes up to the first number come with the first delivery, from the second on
# with the second one; parts in between come with both, changed in the second.
FIRST_SIZES_TO, SECOND_SIZES_FROM = 30, 20
# The same for suppliers, by account balance.
FIRST_BALANCE_FROM, SECOND_BALANCE_TO = 2000, 6000


def sales_order() -> list[Column | str]:
    """Which of several lines with one TransactionID counts: the last shipped."""
    return [F.desc("l_shipdate"), "l_partkey", "l_suppkey"]


def sample_delivery(spark: SparkSession, folder: str, entity: str, delivery: int | None = None) -> DataFrame:
    """An entity as one delivery (``None``), or its first or second part (1, 2)."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    if entity == "sales":
        return _sales(table("lineitem"), delivery)
    if entity == "products":
        return _products(table("part"), delivery)
    if entity == "promotions":
        return _promotions(table("part"), delivery)
    if entity == "stores":
        return _stores(table("supplier"), table("nation"), table("region"), delivery)
    raise ValueError(f"no sample for {entity!r}")


def _sales(lines: DataFrame, delivery: int | None) -> DataFrame:
    if delivery == 1:
        lines = lines.filter(F.col("l_shipdate") < F.lit(SECOND_DELIVERY_FROM).cast("timestamp_ntz"))
    elif delivery == 2:
        lines = lines.filter(F.col("l_shipdate") >= F.lit(SECOND_DELIVERY_FROM).cast("timestamp_ntz"))
    # Whole cents and percents, so that the products are exact.
    cents, percent = F.rint(F.col("l_extendedprice") * 100), F.rint(F.col("l_discount") * 100)
    undated = (F.col("l_tax") == 0.08) & (F.col("l_quantity") == 50)
    nameless = (F.col("l_tax") == 0.07) & (F.col("l_quantity") == 49)
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    return lines.select(
        F.when(~nameless, F.concat("l_orderkey", F.lit("-"), "l_linenumber")).alias("TransactionID"),
        F.when(undated, None).otherwise(F.col("l_shipdate").cast("date")).alias("Date"),
        F.concat(F.lit("S"), "l_suppkey").alias("StoreID"),
        F.concat(F.lit("P"), "l_partkey").alias("ProductID"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("UnitPrice"),
        (cents * percent / 10000).alias("DiscountAmount"),
        (sign * cents * (100 - percent) / 10000).alias("TotalSales"),
        F.when(F.col("l_discount") >= 0.06, F.concat(F.lit("PROMO"), "l_partkey")).alias("PromotionID"),
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
    )


def _parts(parts: DataFrame, delivery: int | None) -> tuple[DataFrame, Column]:
    """The parts of a delivery, and whether a part was already in an earlier one."""
    size = F.col("p_size")
    if delivery == 1:
        return parts.filter(size <= FIRST_SIZES_TO), F.lit(False)
    if delivery == 2:
        return parts.filter(size >= SECOND_SIZES_FROM), size <= FIRST_SIZES_TO
    return parts, F.lit(False)


def _products(parts: DataFrame, delivery: int | None) -> DataFrame:
    parts, changed = _parts(parts, delivery)
    return parts.select(
        F.concat(F.lit("P"), "p_partkey").alias("ProductID"),
        F.col("p_type").alias("Category"),
        # A change can also take a value away.
        F.when(~(changed & (F.col("p_size") == 25)), F.col("p_brand")).alias("Brand"),
        F.when(F.col("p_size") != 49, F.col("p_name")).alias("ProductName"),
        (F.col("p_retailprice") + F.when(changed, 1.0).otherwise(0.0)).alias("BasePrice"),
    )


def _promotions(parts: DataFrame, delivery: int | None) -> DataFrame:
    parts, changed = _parts(parts.filter(F.col("p_type") == "PROMO"), delivery)
    start = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_partkey") % 365).cast("int"))
    spend = (F.col("p_size") % 10) * 1000 + F.when(changed, 500).otherwise(0)
    return parts.select(
        F.concat(F.lit("PROMO"), "p_partkey").alias("PromotionID"),
        F.col("p_brand").alias("PromotionType"),
        start.alias("StartDate"),
        F.when(F.col("p_size") != 50, F.date_add(start, F.col("p_size"))).alias("EndDate"),
        F.col("p_size").cast("double").alias("DiscountPercent"),
        F.concat(F.lit("P"), "p_partkey").alias("ProductID"),
        spend.cast("double").alias("MarketingSpend"),
    )


def _stores(suppliers: DataFrame, nations: DataFrame, regions: DataFrame, delivery: int | None) -> DataFrame:
    balance, changed = F.col("s_acctbal"), F.lit(False)
    if delivery == 1:
        suppliers = suppliers.filter(balance >= FIRST_BALANCE_FROM)
    elif delivery == 2:
        suppliers = suppliers.filter(balance < SECOND_BALANCE_TO)
        changed = balance >= FIRST_BALANCE_FROM
    placed = suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey).join(
        regions, nations.n_regionkey == regions.r_regionkey
    )
    return placed.select(
        F.concat(F.lit("S"), "s_suppkey").alias("StoreID"),
        F.col("s_name").alias("StoreName"),
        F.col("r_name").alias("Region"),
        F.col("n_name").alias("StoreType"),
        (F.floor(balance) + F.when(changed, 100).otherwise(0)).cast("int").alias("SquareFootage"),
    )
