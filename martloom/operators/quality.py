"""Row quality rules, their single-pass counts, and key checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = dict[str, Column]


def present(column: str) -> Column:
    return F.col(column).isNotNull()


def positive(column: str) -> Column:
    return F.col(column) > 0


# The columns a row must fill, and those that must be above zero, to enter silver.
REQUIRED = {
    "sales": ("TransactionID", "Date"),
    "products": ("ProductID", "ProductName"),
    "stores": ("StoreID", "StoreName"),
    "promotions": ("PromotionID", "StartDate", "EndDate"),
}
ABOVE_ZERO = {"sales": ("TotalSales",), "products": ("BasePrice",), "stores": ("SquareFootage",)}


def rules_for(entity: str) -> Rules:
    rules = {f"{column} present": present(column) for column in REQUIRED[entity]}
    rules.update({f"{column} positive": positive(column) for column in ABOVE_ZERO.get(entity, ())})
    return rules


def quality_filter(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that meet every rule; a rule that is NULL for a row counts as not met."""
    return df.filter(reduce(Column.__and__, rules.values()))


def quality_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: rows read, rows meeting all rules, rows failing this rule. One scan."""
    met = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    all_met = reduce(Column.__and__, met.values())
    per_rule = F.array(
        *(F.struct(F.lit(name).alias("rule"), F.count_if(~ok).alias("failed_rows")) for name, ok in met.items())
    )
    return (
        df.agg(
            F.count("*").alias("input_rows"),
            F.count_if(all_met).alias("passed_rows"),
            per_rule.alias("rules"),
        )
        .select("input_rows", "passed_rows", F.inline("rules"))
        .select("rule", "input_rows", "passed_rows", "failed_rows")
    )


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that are missing or repeated, with the number of rows that carry them."""
    return (
        df.groupBy(F.col(key).cast("string").alias("key_value"))
        .agg(F.count("*").alias("row_count"))
        .filter(F.col("key_value").isNull() | (F.col("row_count") > 1))
    )
