from __future__ import annotations

from martloom.plans.audit import rejected_rows


def test_rows_without_a_key_are_counted(spark):
    stores = spark.createDataFrame([("1", "a"), (None, "b"), (None, None)], "StoreID string, StoreName string")
    products = spark.createDataFrame([], "ProductID string")
    found = rejected_rows({"stores": stores, "products": products})
    assert sorted(map(tuple, found.collect())) == [("products", 0, 0), ("stores", 3, 2)]
