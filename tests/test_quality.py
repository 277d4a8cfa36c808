from __future__ import annotations

from martloom.operators.quality import (
    ABOVE_ZERO,
    REQUIRED,
    key_violations,
    quality_counts,
    quality_filter,
    rules_for,
)
from martloom.schemas import BRONZE

# id, date, amount: good; no id; no date; zero; negative; no amount; two faults
SALES = [
    ("t1", "2024-01-01", 5.0),
    (None, "2024-01-01", 5.0),
    ("t3", None, 5.0),
    ("t4", "2024-01-01", 0.0),
    ("t5", "2024-01-01", -1.0),
    ("t6", "2024-01-01", None),
    ("t7", None, -2.0),
]


def sales(spark):
    return spark.createDataFrame(SALES, "TransactionID string, Date string, TotalSales double")


def test_filter_needs_every_rule(spark):
    passed = quality_filter(sales(spark), rules_for("sales"))
    assert [r.TransactionID for r in passed.collect()] == ["t1"]


def test_counts_per_rule_in_one_pass(spark):
    counts = quality_counts(sales(spark), rules_for("sales"))
    assert {tuple(r) for r in counts.collect()} == {
        ("TransactionID present", 7, 1, 1),
        ("Date present", 7, 1, 2),
        ("TotalSales positive", 7, 1, 4),
    }


def test_counts_of_nothing(spark):
    counts = quality_counts(sales(spark).limit(0), rules_for("sales"))
    assert {tuple(r)[1:] for r in counts.collect()} == {(0, 0, 0)}


def test_rules_use_the_columns_of_their_table():
    for entity, spec in BRONZE.items():
        assert set(REQUIRED[entity]) | set(ABOVE_ZERO.get(entity, ())) <= set(spec.columns)


def test_promotion_needs_both_dates(spark):
    rows = [("p1", "2024-01-01", "2024-01-02"), ("p2", "2024-01-01", None), ("p3", None, "2024-01-02")]
    df = spark.createDataFrame(rows, "PromotionID string, StartDate string, EndDate string")
    assert [r.PromotionID for r in quality_filter(df, rules_for("promotions")).collect()] == ["p1"]


def test_key_violations(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    assert {tuple(r) for r in key_violations(df, "id").collect()} == {("b", 2), (None, 1)}
