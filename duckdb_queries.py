"""The registered queries as DuckDB SQL over the same tables.

Two chains of common table expressions, one for a single load of everything and one for two
successive loads, feed the statements. Written for clarity, not for scale.
"""

from __future__ import annotations

from martloom.plans.sample_run import FIRST_RUN, SECOND_RUN
from martloom.sources.sample_tables import (
    FIRST_BALANCE_FROM,
    FIRST_SIZES_TO,
    SECOND_BALANCE_TO,
    SECOND_DELIVERY_FROM,
    SECOND_SIZES_FROM,
)

# The names of the columns and keys, and the rules, of every entity.
RUN = {1: f"TIMESTAMP '{FIRST_RUN}'", 2: f"TIMESTAMP '{SECOND_RUN}'"}
COLUMNS = {
    "sales": "TransactionID Date StoreID ProductID Quantity UnitPrice DiscountAmount TotalSales PromotionID",
    "products": "ProductID Category Brand ProductName BasePrice",
    "stores": "StoreID StoreName Region StoreType SquareFootage",
    "promotions": "PromotionID PromotionType StartDate EndDate DiscountPercent ProductID MarketingSpend",
}
KEY = {"sales": "TransactionID", "products": "ProductID", "stores": "StoreID", "promotions": "PromotionID"}
RULES = {
    "sales": [
        ("TransactionID present", "TransactionID IS NOT NULL"),
        ("Date present", "Date IS NOT NULL"),
        ("TotalSales positive", "TotalSales > 0"),
    ],
    "products": [
        ("ProductID present", "ProductID IS NOT NULL"),
        ("ProductName present", "ProductName IS NOT NULL"),
        ("BasePrice positive", "BasePrice > 0"),
    ],
    "stores": [
        ("StoreID present", "StoreID IS NOT NULL"),
        ("StoreName present", "StoreName IS NOT NULL"),
        ("SquareFootage positive", "SquareFootage > 0"),
    ],
    "promotions": [
        ("PromotionID present", "PromotionID IS NOT NULL"),
        ("StartDate present", "StartDate IS NOT NULL"),
        ("EndDate present", "EndDate IS NOT NULL"),
    ],
}
DIMENSIONS = {
    "products": ("dim_product", "ProductKey", "ProductID ProductName Category Brand BasePrice"),
    "stores": ("dim_store", "StoreKey", "StoreID StoreName Region StoreType SquareFootage"),
    "promotions": (
        "dim_promotion",
        "PromotionKey",
        "PromotionID PromotionType StartDate EndDate DiscountPercent MarketingSpend",
    ),
}
TABLES = [
    *(f"bronze.{e}" for e in COLUMNS),
    *(f"silver.{e}" for e in COLUMNS),
    "gold.dim_date",
    *(f"gold.{d[0]}" for d in DIMENSIONS.values()),
    "gold.fact_sales",
]


def columns(names: str, table: str = "") -> str:
    return ", ".join(f"{table}.{n}" if table else n for n in names.split())


def delivery(entity: str, part: int | None) -> str:
    """Rows of an entity as delivered: all of it, or the first or second part."""
    if entity == "sales":
        where = {
            None: "",
            1: f"WHERE l_shipdate < TIMESTAMP '{SECOND_DELIVERY_FROM}'",
            2: f"WHERE l_shipdate >= TIMESTAMP '{SECOND_DELIVERY_FROM}'",
        }[part]
        return f"""
            SELECT CASE WHEN NOT (l_tax = 0.07 AND l_quantity = 49) THEN CONCAT(l_orderkey, '-', l_linenumber) END
                       AS TransactionID,
                   CASE WHEN l_tax = 0.08 AND l_quantity = 50 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS Date,
                   CONCAT('S', l_suppkey) AS StoreID, CONCAT('P', l_partkey) AS ProductID,
                   CAST(l_quantity AS INTEGER) AS Quantity, l_extendedprice / l_quantity AS UnitPrice,
                   CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(l_discount AS DECIMAL(4, 2)) AS DOUBLE)
                       AS DiscountAmount,
                   CAST((CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END)
                        * CAST(l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2)))
                        AS DOUBLE) AS TotalSales,
                   CASE WHEN l_discount >= 0.06 THEN CONCAT('PROMO', l_partkey) END AS PromotionID,
                   l_shipdate, l_partkey, l_suppkey
            FROM lineitem {where}"""
    if entity == "stores":
        where = {
            None: "",
            1: f"WHERE s_acctbal >= {FIRST_BALANCE_FROM}",
            2: f"WHERE s_acctbal < {SECOND_BALANCE_TO}",
        }[part]
        changed = f"s_acctbal >= {FIRST_BALANCE_FROM}" if part == 2 else "FALSE"
        return f"""
            SELECT CONCAT('S', s_suppkey) AS StoreID, s_name AS StoreName, r_name AS Region, n_name AS StoreType,
                   CAST(FLOOR(s_acctbal) + CASE WHEN {changed} THEN 100 ELSE 0 END AS INTEGER) AS SquareFootage
            FROM supplier
            JOIN nation ON s_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey {where}"""
    where = {None: "TRUE", 1: f"p_size <= {FIRST_SIZES_TO}", 2: f"p_size >= {SECOND_SIZES_FROM}"}[part]
    changed = f"p_size <= {FIRST_SIZES_TO}" if part == 2 else "FALSE"
    if entity == "products":
        return f"""
            SELECT CONCAT('P', p_partkey) AS ProductID, p_type AS Category,
                   CASE WHEN NOT ({changed} AND p_size = 25) THEN p_brand END AS Brand,
                   CASE WHEN p_size <> 49 THEN p_name END AS ProductName,
                   p_retailprice + CASE WHEN {changed} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS BasePrice
            FROM part WHERE {where}"""
    start = "DATE '1995-01-01' + CAST(p_partkey % 365 AS INTEGER)"
    return f"""
        SELECT CONCAT('PROMO', p_partkey) AS PromotionID, p_brand AS PromotionType, {start} AS StartDate,
               CASE WHEN p_size <> 50 THEN {start} + p_size END AS EndDate,
               CAST(p_size AS DOUBLE) AS DiscountPercent, CONCAT('P', p_partkey) AS ProductID,
               CAST((p_size % 10) * 1000 + CASE WHEN {changed} THEN 500 ELSE 0 END AS DOUBLE) AS MarketingSpend
        FROM part WHERE p_type = 'PROMO' AND {where}"""


def one_per_key(entity: str, part: int | None) -> str:
    rows = f"SELECT {columns(COLUMNS[entity])} FROM ({delivery(entity, part)})"
    if entity != "sales":
        return rows
    return rows + """
        WHERE TransactionID IS NOT NULL
        QUALIFY ROW_NUMBER() OVER (PARTITION BY TransactionID
                                   ORDER BY l_shipdate DESC, l_partkey, l_suppkey) = 1"""


def passing(entity: str) -> str:
    return " AND ".join(rule for _, rule in RULES[entity])


def merged(old: str, new: str, key: str) -> str:
    """An upsert without preserved columns: the new rows, and the old ones they do not replace."""
    return f"SELECT * FROM {new} UNION ALL SELECT * FROM {old} ANTI JOIN {new} USING ({key})"


def calendar(sales: str) -> str:
    return f"""
        SELECT day AS DateKey, day AS Date, CAST(YEAR(day) AS INTEGER) AS Year, CAST(MONTH(day) AS INTEGER) AS Month,
               CAST(DAY(day) AS INTEGER) AS DayOfMonth, CAST(DAYOFWEEK(day) + 1 AS INTEGER) AS DayOfWeek,
               CAST(WEEKOFYEAR(day) AS INTEGER) AS WeekOfYear, CAST(QUARTER(day) AS INTEGER) AS Quarter,
               CONCAT(YEAR(day), '-Q', QUARTER(day)) AS QuarterYear, STRFTIME(day, '%a') AS DayName,
               STRFTIME(day, '%b') AS MonthName, DAYOFWEEK(day) IN (0, 6) AS IsWeekend
        FROM (SELECT CAST(UNNEST(GENERATE_SERIES(MIN(Date), MAX(Date), INTERVAL 1 DAY)) AS DATE) AS day
              FROM {sales})"""


def fact(sales: str, product: str, store: str, promotion: str, date: str, stamp: str) -> str:
    return f"""
        SELECT f.TransactionID, d.DateKey, s.StoreKey, p.ProductKey, COALESCE(r.PromotionKey, -1) AS PromotionKey,
               f.Quantity, f.UnitPrice, f.DiscountAmount, f.TotalSales, {stamp} AS _created_at
        FROM {sales} f
        LEFT JOIN {date} d ON f.Date = d.Date
        LEFT JOIN {store} s ON f.StoreID = s.StoreID
        LEFT JOIN {product} p ON f.ProductID = p.ProductID
        LEFT JOIN {promotion} r ON f.PromotionID = r.PromotionID"""


def one_load() -> dict[str, str]:
    steps = {}
    for entity in COLUMNS:
        steps[f"bronze_{entity}"] = f"SELECT *, {RUN[1]} AS _loaded_at FROM ({one_per_key(entity, None)})"
        steps[f"silver_{entity}"] = (
            f"SELECT {columns(COLUMNS[entity])}, {RUN[1]} AS _validated_at FROM bronze_{entity} "
            f"WHERE {passing(entity)}"
        )
    steps["gold_dim_date"] = calendar("silver_sales")
    for entity, (name, surrogate, attributes) in DIMENSIONS.items():
        steps[f"gold_{name}"] = first_dimension(f"silver_{entity}", KEY[entity], surrogate, attributes)
    steps["gold_fact_sales"] = fact(
        "silver_sales", "gold_dim_product", "gold_dim_store", "gold_dim_promotion", "gold_dim_date", RUN[1]
    )
    return steps


def first_dimension(silver: str, key: str, surrogate: str, attributes: str) -> str:
    return (
        f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY {key}) AS INTEGER) AS {surrogate}, "
        f"{columns(attributes)}, {RUN[1]} AS _updated_at FROM {silver}"
    )


def two_loads() -> dict[str, str]:
    steps = {}
    for entity, names in COLUMNS.items():
        key, cols = KEY[entity], columns(names)
        steps[f"bronze_{entity}_1"] = f"SELECT *, {RUN[1]} AS _loaded_at FROM ({one_per_key(entity, 1)})"
        steps[f"bronze_{entity}_new"] = f"SELECT *, {RUN[2]} AS _loaded_at FROM ({one_per_key(entity, 2)})"
        steps[f"bronze_{entity}"] = merged(f"bronze_{entity}_1", f"bronze_{entity}_new", key)
        for source, target, run in (("_1", "_1", 1), ("", "_new", 2)):
            steps[f"silver_{entity}{target}"] = (
                f"SELECT {cols}, {RUN[run]} AS _validated_at FROM bronze_{entity}{source} WHERE {passing(entity)}"
            )
        steps[f"silver_{entity}"] = merged(f"silver_{entity}_1", f"silver_{entity}_new", key)
    for suffix in ("_1", ""):
        steps[f"gold_dim_date{suffix}"] = calendar(f"silver_sales{suffix}")
    for entity, (name, surrogate, attributes) in DIMENSIONS.items():
        key = KEY[entity]
        steps[f"gold_{name}_1"] = first_dimension(f"silver_{entity}_1", key, surrogate, attributes)
        steps[f"gold_{name}"] = f"""
            SELECT CAST(COALESCE(
                       o.{surrogate},
                       (SELECT MAX({surrogate}) FROM gold_{name}_1)
                       + ROW_NUMBER() OVER (PARTITION BY o.{surrogate} IS NULL ORDER BY m.{key})
                   ) AS INTEGER) AS {surrogate},
                   {columns(attributes, "m")}, {RUN[2]} AS _updated_at
            FROM silver_{entity} m LEFT JOIN gold_{name}_1 o ON m.{key} = o.{key}"""
    for suffix, stamp in (
        ("_1", RUN[1]),
        ("", f"CASE WHEN f.TransactionID IN (SELECT TransactionID FROM gold_fact_sales_1) "
             f"THEN {RUN[1]} ELSE {RUN[2]} END"),
    ):
        steps[f"gold_fact_sales{suffix}"] = fact(
            f"silver_sales{suffix}",
            *(f"gold_{DIMENSIONS[e][0]}{suffix}" for e in DIMENSIONS),
            f"gold_dim_date{suffix}",
            stamp,
        )
    return steps


# Through text, which is read as the nearest DOUBLE; a DECIMAL beyond 2**53 units is not.
EXACT = "CAST(CAST(SUM(CAST(f.TotalSales AS DECIMAL(28, 10))) AS VARCHAR) AS DOUBLE)"
UNITS = "CAST(SUM(f.Quantity) AS BIGINT)"
AVERAGE = f"{EXACT} / COUNT(f.TotalSales)"
SALES = "COUNT(DISTINCT f.TransactionID)"
VIEWS = {
    "sales_by_store_product": f"""
        SELECT s.StoreKey, s.StoreName, s.Region, p.ProductKey, p.ProductName, p.Category,
               {SALES} AS total_transactions, {UNITS} AS total_quantity, {EXACT} AS total_revenue,
               {AVERAGE} AS avg_sale_amount, MIN(f.TotalSales) AS min_sale_amount,
               MAX(f.TotalSales) AS max_sale_amount
        FROM gold_fact_sales f LEFT JOIN gold_dim_store s ON f.StoreKey = s.StoreKey
        LEFT JOIN gold_dim_product p ON f.ProductKey = p.ProductKey
        GROUP BY ALL""",
    "daily_sales_by_store": f"""
        SELECT d.Date, s.StoreKey, s.StoreName, s.Region, {SALES} AS daily_transactions,
               {UNITS} AS daily_quantity, {EXACT} AS daily_revenue, {AVERAGE} AS avg_transaction_value
        FROM gold_fact_sales f LEFT JOIN gold_dim_date d ON f.DateKey = d.DateKey
        LEFT JOIN gold_dim_store s ON f.StoreKey = s.StoreKey
        GROUP BY ALL""",
    "product_performance": f"""
        SELECT p.ProductKey, p.ProductID, p.ProductName, p.Category, p.Brand, p.BasePrice,
               {SALES} AS total_sales, {UNITS} AS total_quantity_sold, {EXACT} AS total_revenue,
               AVG(f.Quantity) AS avg_quantity_per_sale, COUNT(DISTINCT f.StoreKey) AS stores_sold_in
        FROM gold_fact_sales f LEFT JOIN gold_dim_product p ON f.ProductKey = p.ProductKey
        GROUP BY ALL""",
    "store_performance": f"""
        SELECT s.StoreKey, s.StoreID, s.StoreName, s.Region, s.StoreType, s.SquareFootage,
               {SALES} AS total_transactions, COUNT(DISTINCT f.ProductKey) AS unique_products_sold,
               {UNITS} AS total_quantity_sold, {EXACT} AS total_revenue, {AVERAGE} AS avg_transaction_value,
               MIN(d.Date) AS first_sale_date, MAX(d.Date) AS last_sale_date
        FROM gold_fact_sales f LEFT JOIN gold_dim_store s ON f.StoreKey = s.StoreKey
        LEFT JOIN gold_dim_date d ON f.DateKey = d.DateKey
        GROUP BY ALL""",
    "promotion_effectiveness": f"""
        SELECT r.PromotionKey, r.PromotionID, r.PromotionType, r.StartDate, r.EndDate, r.DiscountPercent,
               r.MarketingSpend, {SALES} AS total_sales_during_promotion, {UNITS} AS total_quantity_sold,
               {EXACT} AS total_revenue, {AVERAGE} AS avg_sale_amount,
               COUNT(DISTINCT f.StoreKey) AS stores_participating, COUNT(DISTINCT f.ProductKey) AS products_sold,
               ROUND({EXACT} / NULLIF(r.MarketingSpend, 0), 2) AS roi_multiplier
        FROM gold_fact_sales f LEFT JOIN gold_dim_promotion r ON f.PromotionKey = r.PromotionKey
        WHERE f.PromotionKey <> -1
        GROUP BY r.PromotionKey, r.PromotionID, r.PromotionType, r.StartDate, r.EndDate, r.DiscountPercent,
                 r.MarketingSpend""",
    "sales_trend_by_month": f"""
        SELECT d.Year, d.Month, d.MonthName,
               d.Year || '-' || LPAD(CAST(d.Month AS VARCHAR), 2, '0') AS YearMonth,
               {SALES} AS transactions, {UNITS} AS quantity_sold, {EXACT} AS revenue
        FROM gold_fact_sales f LEFT JOIN gold_dim_date d ON f.DateKey = d.DateKey
        GROUP BY d.Year, d.Month, d.MonthName""",
}
TOP = {
    "top5_store_product": ("sales_by_store_product", "total_revenue DESC, StoreKey NULLS FIRST, ProductKey NULLS FIRST"),
    "top5_daily_sales": ("daily_sales_by_store", "Date DESC, daily_revenue DESC, StoreKey NULLS FIRST"),
    "top5_products": ("product_performance", "total_revenue DESC, ProductKey NULLS FIRST"),
    "top5_stores": ("store_performance", "total_revenue DESC, StoreKey NULLS FIRST"),
    "top5_promotions": ("promotion_effectiveness", "total_revenue DESC, PromotionKey NULLS FIRST"),
}
STAR = """
    SELECT f.TransactionID, d.Date, s.StoreName, p.ProductName, r.PromotionType, f.Quantity, f.TotalSales
    FROM gold_fact_sales f
    LEFT JOIN gold_dim_date d ON f.DateKey = d.DateKey
    LEFT JOIN gold_dim_store s ON f.StoreKey = s.StoreKey
    LEFT JOIN gold_dim_product p ON f.ProductKey = p.ProductKey
    LEFT JOIN gold_dim_promotion r ON f.PromotionKey = r.PromotionKey"""


# The fact with whole orders as transactions, and some keys that no dimension has.
ANY_FACT = """
    SELECT SPLIT_PART(TransactionID, '-', 1) AS TransactionID,
           CASE WHEN Quantity % 10 = 3 THEN DateKey + 36500 ELSE DateKey END AS DateKey,
           CASE WHEN Quantity % 10 = 7 THEN StoreKey + 1000000 + Quantity ELSE StoreKey END AS StoreKey,
           CASE WHEN Quantity % 10 = 5 THEN ProductKey + 1000000 ELSE ProductKey END AS ProductKey,
           CASE WHEN Quantity % 10 = 9 AND PromotionKey <> -1 THEN PromotionKey + 1000000 ELSE PromotionKey END
               AS PromotionKey,
           Quantity, TotalSales
    FROM gold_fact_sales"""


def over(steps: dict[str, str], select: str) -> str:
    chain = ",\n".join(f"{name} AS MATERIALIZED ({body})" for name, body in steps.items())
    return f"WITH {chain}\n{select}"


def statements() -> dict[str, str]:
    once, twice = one_load(), two_loads()
    one = {f"csv_{e}": one_per_key(e, None) for e in COLUMNS}
    for entity in COLUMNS:
        for layer in ("bronze", "silver"):
            one[f"{layer}_{entity}"] = over(once, f"SELECT * FROM {layer}_{entity}")
    one["quality_counts"] = over(
        once,
        " UNION ALL ".join(
            f"SELECT '{entity}' AS table_name, '{name}' AS rule, COUNT(*) AS input_rows, "
            f"COUNT(*) FILTER (WHERE {passing(entity)}) AS passed_rows, "
            f"COUNT(*) - COUNT(*) FILTER (WHERE {rule}) AS failed_rows FROM bronze_{entity}"
            for entity, rules in RULES.items()
            for name, rule in rules
        ),
    )
    one["key_violations"] = " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, {KEY[e]} AS key_value, COUNT(*) AS row_count FROM ({delivery(e, None)}) "
        f"GROUP BY {KEY[e]} HAVING COUNT(*) > 1 OR {KEY[e]} IS NULL"
        for e in COLUMNS
    )
    one["date_spine"] = over(once, "SELECT Date FROM gold_dim_date")
    one["dim_date"] = over(once, "SELECT * FROM gold_dim_date")
    for name, _, _ in DIMENSIONS.values():
        one[name] = over(once, f"SELECT * FROM gold_{name}")
    one["fact_sales"] = over(once, "SELECT * FROM gold_fact_sales")
    one["star_rows"] = over(once, STAR)
    one["star_check"] = over(once, STAR + " ORDER BY f.TransactionID LIMIT 10")
    for name, select in VIEWS.items():
        one[name] = over(once, select)
        one[f"any_fact_{name}"] = over(once | {"any_fact": ANY_FACT}, select.replace("gold_fact_sales", "any_fact"))
    one["rejected_rows"] = " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, COUNT(*) AS delivered_rows, COUNT(*) FILTER (WHERE {KEY[e]} IS NULL) "
        f"AS rejected_rows FROM ({delivery(e, None)})"
        for e in COLUMNS
    )
    one["rejected_lines"] = f"""
        SELECT CASE Quantity WHEN 7 THEN 'too many values' WHEN 13 THEN 'too few values' ELSE 'Quantity is no int' END AS reason,
               COUNT(*) AS line_count, MIN(TransactionID) AS first_key, MAX(TransactionID) AS last_key
        FROM ({one_per_key("sales", None)}) WHERE Quantity IN (7, 13, 29) GROUP BY reason"""
    one["csv_past_bad_lines"] = f"SELECT * FROM ({one_per_key('sales', None)}) WHERE Quantity NOT IN (7, 13, 29)"
    one["fixture_stores"] = "SELECT " + ", ".join(
        f"COALESCE(CAST({c} AS VARCHAR), '') AS {c}" for c in COLUMNS["stores"].split()
    ) + f" FROM ({delivery('stores', None)})"
    one["fact_sales_spread"] = one["fact_sales"]
    for name, (view, order) in TOP.items():
        one[name] = over(once, f"SELECT * FROM ({VIEWS[view]}) ORDER BY {order} LIMIT 5")

    two = {
        "layer_row_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t.replace('.', '_')}" for t in TABLES
        ),
        "silver_stale_rows": "SELECT * FROM silver_sales ANTI JOIN "
        f"(SELECT TransactionID FROM bronze_sales WHERE {passing('sales')}) USING (TransactionID)",
        "fact_sales_upsert": "SELECT * FROM gold_fact_sales",
        "refreshed_fact_sales": "SELECT * FROM gold_fact_sales",
        "refreshed_silver_sales": "SELECT * FROM silver_sales",
        "refreshed_dim_date": "SELECT * FROM gold_dim_date",
        "preview_dim_store": "SELECT * FROM gold_dim_store ORDER BY StoreKey LIMIT 10",
    }
    for entity in COLUMNS:
        two[f"upsert_{entity}"] = f"SELECT * FROM bronze_{entity}"
        two[f"silver_upsert_{entity}"] = f"SELECT * FROM silver_{entity}"
    for name, _, _ in DIMENSIONS.values():
        two[f"{name}_incremental"] = f"SELECT * FROM gold_{name}"
    for name, select in VIEWS.items():
        two[f"published_{name}"] = select
    return one | {name: over(twice, select) for name, select in two.items()}
