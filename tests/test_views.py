from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest

from martloom.plans.layers import Star, star_check, star_rows
from martloom.plans.views import VIEWS, top, view
from martloom.schemas import DIM_DATE, DIM_PRODUCT, DIM_PROMOTION, DIM_STORE, FACT_SALES

TS = dt.datetime(2024, 6, 1)
D1, D2, D3 = dt.date(2024, 2, 29), dt.date(2024, 3, 1), dt.date(2024, 3, 2)


def fact(*rows):
    return [(*row[:6], 1.0, 0.0, row[6], TS) for row in rows]


FACTS = fact(
    # id, day, store, product, promotion, quantity, amount
    ("a", D1, 1, 1, -1, 2, 10.10),
    ("b", D1, 1, 1, 1, 1, 0.20),
    ("c", D2, 1, 2, 1, 3, 5.30),
    ("d", D2, 2, 1, 2, None, 7.00),
    ("e", D3, None, 1, -1, 4, None),
    ("f", D3, None, None, 1, 1, 1.00),
)


def star(spark, facts=FACTS, maintained=True) -> Star:
    def days(day):
        return (day, day, day.year, day.month, day.day, 1, 9, 1, "2024-Q1", "Fri", day.strftime("%b"), False)

    return Star(
        fact=spark.createDataFrame(facts, FACT_SALES.schema),
        date=spark.createDataFrame([days(d) for d in (D1, D2, D3)], DIM_DATE.schema),
        store=spark.createDataFrame(
            [(1, "10", "Harbour", "North", "Small", 900, TS), (2, "20", "Hill", "South", "Large", 2500, TS)],
            DIM_STORE.schema,
        ),
        product=spark.createDataFrame(
            [(1, "P1", "Bread", "Food", "Acre", 3.5, TS), (2, "P2", "Spade", "Garden", "Root", 20.0, TS)],
            DIM_PRODUCT.schema,
        ),
        promotion=spark.createDataFrame(
            [(1, "SPRING", "Season", D1, D2, 10.0, 250.0, TS), (2, "FREE", "Gift", D1, D2, 5.0, 0.0, TS)],
            DIM_PROMOTION.schema,
        ),
        maintained=maintained,
    )


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("maintained", [True, False])
def test_by_hand(spark, maintained):
    s = star(spark, maintained=maintained)
    assert rows(
        view("store_performance", s),
        "StoreID", "total_transactions", "unique_products_sold", "total_quantity_sold", "total_revenue",
        "avg_transaction_value", "first_sale_date", "last_sale_date",
    ) == sorted([
        ("10", 3, 2, 6, 15.6, 5.2, D1, D2),
        ("20", 1, 1, None, 7.0, 7.0, D2, D2),
        (None, 2, 1, 5, 1.0, 1.0, D3, D3),
    ], key=str)
    assert rows(
        view("product_performance", s),
        "ProductID", "total_sales", "total_quantity_sold", "total_revenue", "avg_quantity_per_sale", "stores_sold_in",
    ) == sorted([
        ("P1", 4, 7, 17.3, 7 / 3, 2),
        ("P2", 1, 3, 5.3, 3.0, 1),
        (None, 1, 1, 1.0, 1.0, 0),
    ], key=str)
    assert rows(
        view("promotion_effectiveness", s),
        "PromotionID", "total_sales_during_promotion", "total_quantity_sold", "total_revenue", "avg_sale_amount",
        "stores_participating", "products_sold", "roi_multiplier",
    ) == sorted([
        ("SPRING", 3, 5, 6.5, 6.5 / 3, 1, 2, 0.03),
        ("FREE", 1, None, 7.0, 7.0, 1, 1, None),  # nothing was spent
    ], key=str)
    assert [tuple(r) for r in view("sales_trend_by_month", s).collect()] == [
        (2024, 3, "Mar", "2024-03", 4, 8, 13.3),
        (2024, 2, "Feb", "2024-02", 2, 3, 10.3),
    ]
    assert rows(
        view("sales_by_store_product", s),
        "StoreKey", "ProductKey", "total_transactions", "min_sale_amount", "max_sale_amount", "avg_sale_amount",
    ) == sorted([
        (1, 1, 2, 0.2, 10.1, 5.15), (1, 2, 1, 5.3, 5.3, 5.3), (2, 1, 1, 7.0, 7.0, 7.0),
        (None, 1, 1, None, None, None), (None, None, 1, 1.0, 1.0, 1.0),
    ], key=str)
    assert [tuple(r) for r in view("daily_sales_by_store", s).select("Date", "StoreKey", "daily_revenue").collect()] == [
        (D3, None, 1.0), (D2, 2, 7.0), (D2, 1, 5.3), (D1, 1, 10.3),
    ]


UNKNOWN = fact(
    ("g", D3 + dt.timedelta(9), 1, 8, 9, 1, 2.0),
    ("h", D3 + dt.timedelta(8), 1, 9, 8, 1, 4.0),
    ("i", D3 + dt.timedelta(8), 7, 1, 1, 1, 8.0),
)


@pytest.mark.parametrize("facts", [FACTS, FACTS + UNKNOWN])
@pytest.mark.parametrize("name", VIEWS)
def test_both_ways_agree_where_no_transaction_repeats(spark, name, facts):
    lean, plain = view(name, star(spark, facts)), view(name, star(spark, facts, maintained=False))
    assert lean.schema.simpleString() == plain.schema.simpleString()
    assert rows(lean, "*") == rows(plain, "*")


def test_any_fact_counts_a_repeated_transaction_once_and_groups_unknown_keys(spark):
    facts = fact(
        ("a", D1, 1, 1, 1, 1, 1.0),
        ("a", D2, 1, 2, 1, 1, 2.0),
        ("b", D1, 8, 1, 1, 1, 4.0),
        ("b", D1, 9, 1, 1, 1, 8.0),
        ("c", D1, 9, 1, 1, 1, 16.0),
    )
    s = star(spark, facts, maintained=False)
    assert rows(view("store_performance", s), "StoreKey", "total_transactions", "unique_products_sold", "total_revenue") == [
        (1, 1, 2, 3.0), (None, 2, 1, 28.0),
    ]
    assert rows(view("sales_trend_by_month", s), "Month", "transactions", "revenue") == [(2, 3, 29.0), (3, 1, 2.0)]
    # The fact's own store keys are counted, known or not.
    assert rows(view("product_performance", s), "ProductKey", "stores_sold_in") == [(1, 3), (2, 1)]


def test_total_does_not_depend_on_the_order_of_rows(spark):
    facts = fact(*((f"t{i}", D1, 1, 1, -1, 1, round(0.1 + i * 0.0101, 4)) for i in range(3000)))
    once = star(spark, facts)
    again = Star(once.fact.repartition(7), once.date, once.store, once.product, once.promotion, True)
    exact = sum(round((0.1 + i * 0.0101) * 10000) for i in range(3000)) / 10000
    for s in (once, again):
        assert view("store_performance", s).first().total_revenue == exact


def test_unknown_days_meet_in_one_group(spark):
    found = rows(view("daily_sales_by_store", star(spark, FACTS + UNKNOWN)), "Date", "StoreKey", "daily_revenue")
    assert [r for r in found if r[0] is None] == [(None, 1, 6.0), (None, None, 8.0)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_money_of_any_size(spark, ansi):
    nan, inf = float("nan"), float("inf")
    amounts = {1: [0.00004] * 1000, 2: [5e14, 5e14], 3: [1e300, 2.0], 4: [nan, 1.0], 5: [inf, 1.0], 6: [inf, -inf], 7: [None]}
    facts = fact(*((f"{k}-{i}", D1, 1, k, -1, 1, x) for k, held in amounts.items() for i, x in enumerate(held)))
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        s = star(spark, facts)
        s = replace(s, product=spark.createDataFrame([(k, f"P{k}", "", "", "", 1.0, TS) for k in amounts], DIM_PRODUCT.schema))
        found = {r.ProductKey: r.total_revenue for r in view("product_performance", s).collect()}
        whole = view("store_performance", s).first().total_revenue
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert (found[1], found[2], found[3], found[5], found[7]) == (0.04, 1e15, 1e300, inf, None)
    assert found[4] != found[4] and found[6] != found[6] and whole != whole


def test_views_come_in_their_order(spark):
    revenue = [r.total_revenue for r in view("store_performance", star(spark)).collect()]
    assert revenue == sorted(revenue, reverse=True)


def test_top_breaks_ties_by_key(spark):
    facts = fact(*((f"t{k}", D1, k, 1, -1, 1, 5.0) for k in (2, 1)), ("n", D1, None, 1, -1, 1, 1.0))
    assert [r.StoreKey for r in top("store_performance", star(spark, facts), 2).collect()] == [1, 2]


def test_star_rows(spark):
    assert rows(star_rows(star(spark)), "TransactionID", "Date", "StoreName", "ProductName", "PromotionType") == [
        ("a", D1, "Harbour", "Bread", None),
        ("b", D1, "Harbour", "Bread", "Season"),
        ("c", D2, "Harbour", "Spade", "Season"),
        ("d", D2, "Hill", "Bread", "Gift"),
        ("e", D3, None, "Bread", None),
        ("f", D3, None, None, "Season"),
    ]
    assert [r.TransactionID for r in star_check(star(spark), 2).collect()] == ["a", "b"]
