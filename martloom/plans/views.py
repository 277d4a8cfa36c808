"""The six analytics views, as SQL that serves DataFrames and catalog tables alike.

A view first sums the fact per fact key (the grain), then joins dimensions to the grain, and last
groups by the keys that were found: the partial sums absorb hot keys before the shuffle, the joins
move groups, not sales, and sales whose keys no dimension has meet in one NULL group.

In a fact table kept by this library (``Star.maintained``) no TransactionID repeats, so counting
distinct ones is counting rows. For any other fact table the grain has the TransactionID as well,
and they are told apart after the joins.

Different stores and products are counted by bits: surrogate keys are whole numbers, and the grain has 64 of
them to a row, a word of bits that are put together by OR. So a group holds a 64th of its different keys.

Money is summed exactly, with ten digits after the point, so that a total does not depend on the order of
the rows. An amount below 2**17 is a whole number of these digits, cut into two limbs; their sums stay within
64 bits for 2 * 10**11 sales in a group (beyond, the query fails), and make a DECIMAL at the end. Larger amounts
are summed as DECIMAL, those of 1e15 and more, infinite ones and NaN as DOUBLE beside it; they concern the
groups that hold them only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.plans.layers import NO_PROMOTION, Star
from martloom.schemas import DIM_DATE, DIM_PRODUCT, DIM_PROMOTION, DIM_STORE, FACT_SALES
from martloom.sources.warehouse import Warehouse

# Table placeholder in the SQL, by the key it is joined on.
DIMENSION_OF = {"DateKey": "date", "StoreKey": "store", "ProductKey": "product", "PromotionKey": "promotion"}

# A double below this is nearer to a number of ten digits after the point than to any other such number.
SMALL = f"ABS(f.TotalSales) < {2**17}"
EXACT = "ABS(f.TotalSales) < 1e15"
DIGITS = f"""CASE WHEN {SMALL} THEN CAST(f.TotalSales AS BIGINT) * 10000000000
    + CAST(ROUND((f.TotalSales - CAST(f.TotalSales AS BIGINT)) * 1e10) AS BIGINT) END AS digits"""
MEASURES = f"""
    SUM(f.Quantity) AS quantity, COUNT(f.Quantity) AS quantities,
    SUM(SHIFTRIGHT(f.digits, 25)) AS high, SUM(f.digits & {2**25 - 1}) AS low,
    SUM(CASE WHEN NOT {SMALL} AND {EXACT} THEN CAST(f.TotalSales AS DECIMAL(28, 10)) END) AS large,
    SUM(CASE WHEN NOT {EXACT} THEN f.TotalSales END) AS beyond, COUNT(f.TotalSales) AS amounts,
    MIN(f.TotalSales) AS lowest, MAX(f.TotalSales) AS highest"""
ADDED = ("quantity", "quantities", "high", "low", "large", "beyond", "amounts")
# The exact part of a total: a step of the high limb is 2**25 of the last digit.
EXACT_SUM = """(CAST(COALESCE(k.high, 0) AS DECIMAL(19, 0)) * 0.0033554432 + CAST(COALESCE(k.low, 0) AS DECIMAL(19, 0)) * 0.0000000001
               + CAST(COALESCE(k.large, 0) AS DECIMAL(37, 10)))"""
REVENUE = f"""CASE WHEN k.beyond IS NOT NULL THEN CAST({EXACT_SUM} AS DOUBLE) + k.beyond
               WHEN k.high IS NOT NULL OR k.large IS NOT NULL THEN CAST({EXACT_SUM} AS DOUBLE) END"""
AVERAGE_SALE = f"({REVENUE}) / NULLIF(k.amounts, 0)"


def sums(once: str = "") -> str:
    """Totals of rows of the grain; of those that ``once`` says, where a row comes several times."""
    added = (f"SUM(CASE WHEN {once} THEN g.{c} END) AS {c}" if once else f"SUM(g.{c}) AS {c}" for c in ADDED)
    return f"{', '.join(added)}, MIN(g.lowest) AS lowest, MAX(g.highest) AS highest"


def totals_sql(
    keys: Sequence[str],
    maintained: bool,
    distinct: Sequence[str] = (),
    where: str = "",
    groups: Sequence[str] = (),
) -> str:
    """Totals of the fact by its ``keys`` as their dimensions have them, or by ``groups``, columns of
    the dimensions; with the number of different values of ``distinct`` columns of the fact, whole
    numbers, as ``different_<column>``."""
    found = groups or [f"by_{key}.{key}" for key in keys]
    names = [x.split(".")[1] for x in found]
    words = [f"SHIFTRIGHT(f.{c}, 6) AS word_{c}" for c in distinct]
    bits = [f"BIT_OR(SHIFTLEFT(CAST(1 AS BIGINT), CAST(f.{c} & 63 AS INT))) AS bits_{c}" for c in distinct]
    grain = [f"f.{c}" for c in (*keys, *(() if maintained else ["TransactionID"]))]
    by = ", ".join([*grain, *(x.split(" AS ")[0] for x in words)])
    counted = ", ".join([*grain, *words, "COUNT(f.TransactionID) AS transactions", *bits, MEASURES])
    rows = f"(SELECT {counted} FROM (SELECT *, {DIGITS} FROM {{fact}} f {where}) f GROUP BY {by}) g {_found(keys)}"
    if not distinct:
        how = "SUM(g.transactions)" if maintained else "COUNT(DISTINCT g.TransactionID)"
        return f"SELECT {', '.join(found)}, {how} AS transactions, {sums()} FROM {rows} GROUP BY {', '.join(found)}"
    if maintained and len(distinct) == 1:
        (column,) = distinct
        return f"""
            SELECT {", ".join(names)}, SUM(g.transactions) AS transactions, {sums()}, COALESCE(SUM(BIT_COUNT(g.bits)), 0) AS different_{column}
            FROM (SELECT {", ".join(found)}, g.word_{column}, SUM(g.transactions) AS transactions, BIT_OR(g.bits_{column}) AS bits, {sums()}
                  FROM {rows} GROUP BY {", ".join(found)}, g.word_{column}) g
            GROUP BY {", ".join(names)}"""
    # Several things to tell apart: a row of the grain comes once for each, with its totals the first time.
    kinds = [f"STRUCT({i} AS kind, g.word_{c} AS word, g.bits_{c} AS bits, CAST(NULL AS STRING) AS id)" for i, c in enumerate(distinct)]
    if not maintained:
        kinds.append(f"STRUCT({len(distinct)} AS kind, NULL AS word, NULL AS bits, g.TransactionID AS id)")
    how = "SUM(g.transactions)" if maintained else "COUNT(g.id)"
    different = (f"COALESCE(SUM(CASE WHEN g.kind = {i} THEN BIT_COUNT(g.bits) END), 0) AS different_{c}" for i, c in enumerate(distinct))
    inner = ", ".join([*found, "x.kind", "x.word", "x.id"])
    return f"""
        SELECT {", ".join(names)}, {how} AS transactions, {sums()}, {", ".join(different)}
        FROM (SELECT {inner}, SUM(CASE WHEN x.kind = 0 THEN g.transactions END) AS transactions, BIT_OR(x.bits) AS bits, {sums("x.kind = 0")}
              FROM {rows} LATERAL VIEW INLINE(ARRAY({", ".join(kinds)})) x AS kind, word, bits, id
              GROUP BY {inner}) g
        GROUP BY {", ".join(names)}"""


def days_sql(key: str) -> str:
    """The first and the last day of sale by ``key``, of the days the calendar has."""
    return f"""
        SELECT by_{key}.{key}, MIN(by_DateKey.Date) AS first_day, MAX(by_DateKey.Date) AS last_day
        FROM (SELECT f.{key}, f.DateKey FROM {{fact}} f GROUP BY f.{key}, f.DateKey) g
        {_found([key, "DateKey"])}
        GROUP BY by_{key}.{key}"""


def _found(keys: Sequence[str]) -> str:
    return " ".join(f"LEFT JOIN {{{DIMENSION_OF[key]}}} by_{key} ON by_{key}.{key} = g.{key}" for key in keys)


def sales_by_store_product(maintained: bool) -> str:
    return f"""
        SELECT s.StoreKey, s.StoreName, s.Region, p.ProductKey, p.ProductName, p.Category,
               k.transactions AS total_transactions, k.quantity AS total_quantity,
               {REVENUE} AS total_revenue, {AVERAGE_SALE} AS avg_sale_amount,
               k.lowest AS min_sale_amount, k.highest AS max_sale_amount
        FROM ({totals_sql(["StoreKey", "ProductKey"], maintained)}) k
        LEFT JOIN {{store}} s ON s.StoreKey = k.StoreKey
        LEFT JOIN {{product}} p ON p.ProductKey = k.ProductKey"""


def daily_sales_by_store(maintained: bool) -> str:
    return f"""
        SELECT d.Date, s.StoreKey, s.StoreName, s.Region, k.transactions AS daily_transactions,
               k.quantity AS daily_quantity, {REVENUE} AS daily_revenue,
               {AVERAGE_SALE} AS avg_transaction_value
        FROM ({totals_sql(["DateKey", "StoreKey"], maintained)}) k
        LEFT JOIN {{date}} d ON d.DateKey = k.DateKey
        LEFT JOIN {{store}} s ON s.StoreKey = k.StoreKey
        ORDER BY Date DESC, daily_revenue DESC"""


def product_performance(maintained: bool) -> str:
    return f"""
        SELECT p.ProductKey, p.ProductID, p.ProductName, p.Category, p.Brand, p.BasePrice,
               k.transactions AS total_sales, k.quantity AS total_quantity_sold,
               {REVENUE} AS total_revenue,
               k.quantity / NULLIF(k.quantities, 0) AS avg_quantity_per_sale,
               k.different_StoreKey AS stores_sold_in
        FROM ({totals_sql(["ProductKey"], maintained, ["StoreKey"])}) k
        LEFT JOIN {{product}} p ON p.ProductKey = k.ProductKey
        ORDER BY total_revenue DESC"""


def store_performance(maintained: bool) -> str:
    return f"""
        SELECT s.StoreKey, s.StoreID, s.StoreName, s.Region, s.StoreType, s.SquareFootage,
               k.transactions AS total_transactions, k.different_ProductKey AS unique_products_sold,
               k.quantity AS total_quantity_sold, {REVENUE} AS total_revenue,
               {AVERAGE_SALE} AS avg_transaction_value,
               y.first_day AS first_sale_date, y.last_day AS last_sale_date
        FROM ({totals_sql(["StoreKey"], maintained, ["ProductKey"])}) k
        LEFT JOIN ({days_sql("StoreKey")}) y ON y.StoreKey <=> k.StoreKey
        LEFT JOIN {{store}} s ON s.StoreKey = k.StoreKey
        ORDER BY total_revenue DESC"""


def promotion_effectiveness(maintained: bool) -> str:
    promoted = f"WHERE f.PromotionKey <> {NO_PROMOTION}"
    return f"""
        SELECT r.PromotionKey, r.PromotionID, r.PromotionType, r.StartDate, r.EndDate,
               r.DiscountPercent, r.MarketingSpend,
               k.transactions AS total_sales_during_promotion, k.quantity AS total_quantity_sold,
               {REVENUE} AS total_revenue, {AVERAGE_SALE} AS avg_sale_amount,
               k.different_StoreKey AS stores_participating, k.different_ProductKey AS products_sold,
               ROUND(({REVENUE}) / NULLIF(r.MarketingSpend, 0), 2) AS roi_multiplier
        FROM ({totals_sql(["PromotionKey"], maintained, ["StoreKey", "ProductKey"], where=promoted)}) k
        LEFT JOIN {{promotion}} r ON r.PromotionKey = k.PromotionKey
        ORDER BY total_revenue DESC"""


def sales_trend_by_month(maintained: bool) -> str:
    month = [f"by_DateKey.{c}" for c in ("Year", "Month", "MonthName")]
    return f"""
        SELECT k.Year, k.Month, k.MonthName, DATE_FORMAT(MAKE_DATE(k.Year, k.Month, 1), 'yyyy-MM') AS YearMonth,
               k.transactions, k.quantity AS quantity_sold, {REVENUE} AS revenue
        FROM ({totals_sql(["DateKey"], maintained, groups=month)}) k
        ORDER BY Year DESC, Month DESC"""


# The names of the views and of their columns, above.
# Each view with the columns its first rows are taken by: descending ones, then ascending ones.
VIEWS = {
    "sales_by_store_product": (sales_by_store_product, ["total_revenue"], ["StoreKey", "ProductKey"]),
    "daily_sales_by_store": (daily_sales_by_store, ["Date", "daily_revenue"], ["StoreKey"]),
    "product_performance": (product_performance, ["total_revenue"], ["ProductKey"]),
    "store_performance": (store_performance, ["total_revenue"], ["StoreKey"]),
    "promotion_effectiveness": (promotion_effectiveness, ["total_revenue"], ["PromotionKey"]),
    "sales_trend_by_month": (sales_trend_by_month, ["Year", "Month"], []),
}


def view(name: str, star: Star) -> DataFrame:
    sql, _, _ = VIEWS[name]
    tables = {
        "fact": star.fact,
        "date": star.date,
        "store": star.store,
        "product": star.product,
        "promotion": star.promotion,
    }
    return star.fact.sparkSession.sql(sql(star.maintained), **tables)


def top(name: str, star: Star, rows: int = 5) -> DataFrame:
    """The first rows of a view; ties are broken by key, so the result is always the same."""
    _, descending, ascending = VIEWS[name]
    return view(name, star).orderBy(*(F.desc(c) for c in descending), *ascending).limit(rows)


def publish_views(warehouse: Warehouse) -> None:
    """(Re)create the views over the gold tables of the catalog."""
    tables = {
        "fact": warehouse.name(FACT_SALES),
        "date": warehouse.name(DIM_DATE),
        "store": warehouse.name(DIM_STORE),
        "product": warehouse.name(DIM_PRODUCT),
        "promotion": warehouse.name(DIM_PROMOTION),
    }
    for name, (sql, _, _) in VIEWS.items():
        warehouse.publish_view("gold", name, sql(maintained=True).format(**tables))
