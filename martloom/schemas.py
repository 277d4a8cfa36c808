"""The tables of the three layers: columns, keys and audit columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableSpec:
    layer: str
    name: str
    ddl: str
    key: str
    stamp: str | None = None
    surrogate: str | None = None
    # Tables that grow with the sales are kept in parts by this column, a day, or in buckets by their key;
    # the others are not.
    day: str | None = None

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def grows(self) -> bool:
        return self.day is not None

    @property
    def label(self) -> str:
        return f"{self.layer}.{self.name}"


# Column names, types and keys of the retail data model.
ENTITY_COLUMNS = {
    "sales": "TransactionID string, Date date, StoreID string, ProductID string, Quantity int, "
    "UnitPrice double, DiscountAmount double, TotalSales double, PromotionID string",
    "products": "ProductID string, Category string, Brand string, ProductName string, BasePrice double",
    "stores": "StoreID string, StoreName string, Region string, StoreType string, SquareFootage int",
    "promotions": "PromotionID string, PromotionType string, StartDate date, EndDate date, "
    "DiscountPercent double, ProductID string, MarketingSpend double",
}
ENTITY_KEY = {
    "sales": "TransactionID",
    "products": "ProductID",
    "stores": "StoreID",
    "promotions": "PromotionID",
}
ENTITIES = tuple(ENTITY_COLUMNS)


def _layer(layer: str, stamp: str) -> dict[str, TableSpec]:
    return {
        entity: TableSpec(
            layer,
            entity,
            f"{columns}, {stamp} timestamp",
            ENTITY_KEY[entity],
            stamp,
            day="Date" if entity == "sales" else None,
        )
        for entity, columns in ENTITY_COLUMNS.items()
    }


BRONZE = _layer("bronze", "_loaded_at")
SILVER = _layer("silver", "_validated_at")

DIM_DATE = TableSpec(
    "gold",
    "dim_date",
    "DateKey date, Date date, Year int, Month int, DayOfMonth int, DayOfWeek int, WeekOfYear int, "
    "Quarter int, QuarterYear string, DayName string, MonthName string, IsWeekend boolean",
    "DateKey",
)
DIM_PRODUCT = TableSpec(
    "gold",
    "dim_product",
    "ProductKey int, ProductID string, ProductName string, Category string, Brand string, "
    "BasePrice double, _updated_at timestamp",
    "ProductID",
    "_updated_at",
    "ProductKey",
)
DIM_STORE = TableSpec(
    "gold",
    "dim_store",
    "StoreKey int, StoreID string, StoreName string, Region string, StoreType string, "
    "SquareFootage int, _updated_at timestamp",
    "StoreID",
    "_updated_at",
    "StoreKey",
)
# A promotion's product is deliberately not part of the dimension.
DIM_PROMOTION = TableSpec(
    "gold",
    "dim_promotion",
    "PromotionKey int, PromotionID string, PromotionType string, StartDate date, EndDate date, "
    "DiscountPercent double, MarketingSpend double, _updated_at timestamp",
    "PromotionID",
    "_updated_at",
    "PromotionKey",
)
FACT_SALES = TableSpec(
    "gold",
    "fact_sales",
    "TransactionID string, DateKey date, StoreKey int, ProductKey int, PromotionKey int, Quantity int, "
    "UnitPrice double, DiscountAmount double, TotalSales double, _created_at timestamp",
    "TransactionID",
    "_created_at",
    day="DateKey",
)
# The entity each overwrite-style dimension is built from.
DIMENSIONS = {"products": DIM_PRODUCT, "stores": DIM_STORE, "promotions": DIM_PROMOTION}

TABLES = (*BRONZE.values(), *SILVER.values(), DIM_DATE, *DIMENSIONS.values(), FACT_SALES)
