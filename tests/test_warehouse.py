from __future__ import annotations

import uuid

import pytest

from martloom.schemas import DIM_STORE, FACT_SALES, SILVER, TABLES
from martloom.sources.warehouse import Warehouse

STORES = SILVER["stores"]


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"t{uuid.uuid4().hex[:8]}", str(tmp_path / "wh"))


def store(spark, *ids):
    rows = [(i, f"store {i}", "North", "Small", 1, None) for i in ids]
    return spark.createDataFrame(rows, STORES.schema)


def versions(warehouse, spec):
    found = warehouse.spark.sql(f"SHOW TABLES IN {warehouse.database(spec.layer)} LIKE '{spec.name}__*'")
    return [r.tableName for r in found.collect()]


def test_created_empty_and_typed_once(spark, warehouse):
    for spec in TABLES:
        warehouse.ensure(spec)
        assert warehouse.read(spec).schema.simpleString() == spec.schema.simpleString()
        assert warehouse.read(spec).count() == 0
    warehouse.replace(STORES, store(spark, "1"))
    warehouse.ensure(STORES)
    assert warehouse.read(STORES).count() == 1


def test_table_can_be_replaced_from_itself(spark, warehouse):
    warehouse.replace(STORES, store(spark, "1", "2"))
    reader = warehouse.read(STORES)
    warehouse.replace(STORES, reader.filter("StoreID = '1'"))
    assert [r.StoreID for r in warehouse.read(STORES).collect()] == ["1"]
    # Readers of the state before are not cut off ...
    assert reader.count() == 2
    warehouse.replace(STORES, store(spark, "3"))
    # ... and older states are dropped.
    assert len(versions(warehouse, STORES)) == 2


def test_view_follows_the_table(spark, warehouse):
    warehouse.replace(STORES, store(spark, "1"))
    warehouse.publish_view("gold", "store_ids", f"SELECT StoreID FROM {warehouse.name(STORES)}")
    name = f"{warehouse.database('gold')}.store_ids"
    assert [r.StoreID for r in spark.table(name).collect()] == ["1"]
    warehouse.replace(STORES, store(spark, "1", "2"))
    assert sorted(r.StoreID for r in spark.table(name).collect()) == ["1", "2"]
    assert warehouse.preview(STORES, 1).count() == 1


def test_failed_save_leaves_the_table_as_it_was(spark, warehouse):
    warehouse.replace(STORES, store(spark, "1"))
    with pytest.raises(Exception, match="broken"):
        warehouse.replace(STORES, store(spark, "2").filter("raise_error('broken') IS NULL"))
    assert [r.StoreID for r in warehouse.read(STORES).collect()] == ["1"]


def test_key_is_recorded_and_sales_are_bucketed(spark, warehouse):
    warehouse.ensure(FACT_SALES)
    warehouse.ensure(DIM_STORE)
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {warehouse.name(FACT_SALES)}").collect()}
    assert properties["martloom.key"] == "TransactionID"

    def description(spec):
        table = f"{warehouse.database(spec.layer)}.{versions(warehouse, spec)[0]}"
        return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}

    assert description(FACT_SALES)["Num Buckets"] == str(warehouse.buckets)
    assert description(FACT_SALES)["Bucket Columns"] == "[`TransactionID`]"
    assert "Num Buckets" not in description(DIM_STORE)


def test_catalogs_are_apart(spark, tmp_path):
    one, other = (Warehouse(spark, f"{c}{uuid.uuid4().hex[:8]}", str(tmp_path)) for c in ("dev", "prod"))
    one.replace(STORES, store(spark, "1"))
    assert not other.exists(STORES)
