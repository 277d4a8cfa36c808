from __future__ import annotations

import datetime as dt
import uuid

import pytest

from martloom.operators.lookup import BROADCAST_SETTING
from martloom.plans.refresh import read_star, refresh
from martloom.plans.views import VIEWS, view
from martloom.schemas import BRONZE, DIM_DATE, DIM_PRODUCT, DIM_STORE, FACT_SALES, SILVER, TABLES
from martloom.sources.warehouse import Warehouse
from tests import samples

RUN_1, RUN_2 = "2024-06-01 00:00:00", "2024-06-02 00:00:00"
SALES_HEADER = samples.SALES.splitlines()[0] + "\n"


@pytest.fixture(params=[None, "day"], ids=["buckets", "days"])
def warehouse(spark, tmp_path, request):
    return Warehouse(spark, f"t{uuid.uuid4().hex[:8]}", str(tmp_path / "wh"), parts=request.param)


def rows(warehouse, spec, stamps=True):
    kept = [c for c in spec.columns if stamps or c != spec.stamp]
    return sorted(map(tuple, warehouse.read(spec).select(*kept).collect()), key=str)


def by_id(warehouse, spec):
    return {getattr(r, spec.key): r for r in warehouse.read(spec).collect()}


def test_first_run(spark, warehouse, tmp_path):
    counts = refresh(warehouse, samples.deliver(spark, tmp_path / "in"), RUN_1)
    assert {r.table_name: r.row_count for r in counts.collect()} == {
        # The sale without ID stays out.
        "bronze.sales": 7, "bronze.products": 3, "bronze.stores": 3, "bronze.promotions": 3,
        "silver.sales": 5, "silver.products": 2, "silver.stores": 2, "silver.promotions": 2,
        "gold.dim_date": 4, "gold.dim_product": 2, "gold.dim_store": 2, "gold.dim_promotion": 2,
        "gold.fact_sales": 5,
    }
    facts = by_id(warehouse, FACT_SALES)
    keys = {i: (f.DateKey, f.StoreKey, f.ProductKey, f.PromotionKey) for i, f in facts.items()}
    assert keys == {
        "A1": (dt.date(2024, 2, 27), 1, 1, -1),
        "A2": (dt.date(2024, 2, 27), 1, 2, 2),
        "A3": (dt.date(2024, 2, 28), 2, 1, 2),
        "A4": (dt.date(2024, 3, 1), 2, None, -1),  # a product silver refuses, a promotion nobody knows
        "A5": (dt.date(2024, 3, 1), None, 1, 1),  # a store nobody knows
    }


def test_second_run_of_the_same_delivery_changes_stamps_only(spark, warehouse, tmp_path):
    delivery = samples.deliver(spark, tmp_path / "in")
    refresh(warehouse, delivery, RUN_1)
    before = {spec.label: rows(warehouse, spec, stamps=False) for spec in TABLES}
    refresh(warehouse, delivery, RUN_2)
    assert {spec.label: rows(warehouse, spec, stamps=False) for spec in TABLES} == before
    second = dt.datetime(2024, 6, 2)
    assert {r._loaded_at for r in warehouse.read(BRONZE["sales"]).collect()} == {second}
    assert {r._validated_at for r in warehouse.read(SILVER["sales"]).collect()} == {second}
    assert {r._updated_at for r in warehouse.read(DIM_STORE).collect()} == {second}
    # A sale keeps the time it entered the fact table.
    assert {r._created_at for r in warehouse.read(FACT_SALES).collect()} == {dt.datetime(2024, 6, 1)}


def test_changes_of_a_second_delivery(spark, warehouse, tmp_path):
    refresh(warehouse, samples.deliver(spark, tmp_path / "one"), RUN_1)
    refresh(
        warehouse,
        samples.deliver(
            spark,
            tmp_path / "two",
            sales=SALES_HEADER
            + "A1,2024-02-27,10,P1,2,3.50,7.00,0.00,\n"  # was good, now without revenue
            + "A2,2024-02-28,10,P2,3,20.00,5.00,55.00,\n"  # changed, promotion taken away
            + "A9,2024-03-03,05,P0,1,9.00,0.00,9.00,\n",  # new
            stores=samples.STORES.splitlines()[0] + "\n05,First,North,Small,100\n20,Hill,,Large,2600\n",
            products=samples.PRODUCTS.splitlines()[0] + "\nP0,Food,Acre,Cake,9.00\nP3,Garden,Root,Rake,8.10\n",
        ),
        RUN_2,
    )
    # A row that turned bad keeps its good state in silver and in the fact table.
    stale = by_id(warehouse, SILVER["sales"])["A1"]
    assert (stale.TotalSales, stale._validated_at) == (7.0, dt.datetime(2024, 6, 1))
    facts = by_id(warehouse, FACT_SALES)
    assert facts["A1"].TotalSales == 7.0
    assert (facts["A2"].Quantity, facts["A2"].PromotionKey, facts["A2"]._created_at) == (
        3, -1, dt.datetime(2024, 6, 1),
    )
    # New members are numbered after the others, though their IDs sort first.
    stores = by_id(warehouse, DIM_STORE)
    assert {i: r.StoreKey for i, r in stores.items()} == {"10": 1, "20": 2, "05": 3}
    assert (stores["20"].Region, stores["20"].SquareFootage) == (None, 2600)
    products = by_id(warehouse, DIM_PRODUCT)
    assert {i: r.ProductKey for i, r in products.items()} == {"P1": 1, "P2": 2, "P0": 3, "P3": 4}
    assert (facts["A9"].StoreKey, facts["A9"].ProductKey, facts["A9"]._created_at) == (3, 3, dt.datetime(2024, 6, 2))
    # A product that came late is found by the sales that were waiting for it.
    assert facts["A4"].ProductKey == 4
    assert warehouse.read(DIM_DATE).count() == 6


def test_repeated_key_in_a_delivery(spark, warehouse, tmp_path):
    twice = SALES_HEADER + "A1,2024-02-27,10,P1,2,3.50,0.00,7.00,\n" * 2
    delivery = samples.deliver(spark, tmp_path / "in", sales=twice)
    with pytest.raises(Exception, match="repeats TransactionID A1"):
        refresh(warehouse, delivery, RUN_1)
    refresh(warehouse, delivery, RUN_1, order_by={"sales": ["Quantity"]})
    assert warehouse.read(FACT_SALES).count() == 1


def test_no_sales_at_all(spark, warehouse, tmp_path):
    refresh(warehouse, samples.deliver(spark, tmp_path / "in", sales=SALES_HEADER))
    assert warehouse.read(DIM_DATE).count() == 0
    assert warehouse.read(FACT_SALES).count() == 0
    for name in VIEWS:
        assert spark.table(f"{warehouse.database('gold')}.{name}").count() == 0


def test_published_views_equal_the_frames(spark, warehouse, tmp_path):
    refresh(warehouse, samples.deliver(spark, tmp_path / "in"), RUN_1)
    for name in VIEWS:
        published = spark.table(f"{warehouse.database('gold')}.{name}")
        frame = view(name, read_star(warehouse))
        assert published.schema.simpleString() == frame.schema.simpleString()
        assert sorted(map(str, published.collect())) == sorted(map(str, frame.collect()))


def files_per_bucket(warehouse):
    files = [f.rsplit("_", 1)[1] for f in warehouse.read(FACT_SALES).inputFiles()]
    return max(files.count(bucket) for bucket in files)


def test_other_numbers_of_buckets(spark, tmp_path):
    catalog, delivery = f"t{uuid.uuid4().hex[:8]}", samples.deliver(spark, tmp_path / "in")
    before = None
    for buckets in (11, 11, 8):
        warehouse = Warehouse(spark, catalog, str(tmp_path / "wh"), buckets)
        refresh(warehouse, delivery, RUN_1)
        assert before in (None, rows(warehouse, FACT_SALES))
        assert files_per_bucket(warehouse) == 1
        before = rows(warehouse, FACT_SALES)


def test_dimensions_too_large_to_broadcast_give_the_same_facts(spark, warehouse, tmp_path):
    delivery = samples.deliver(spark, tmp_path / "in")
    refresh(warehouse, delivery, RUN_1)
    before = rows(warehouse, FACT_SALES)
    spark.conf.set(BROADCAST_SETTING, "0")
    try:
        refresh(warehouse, delivery, RUN_2)
    finally:
        spark.conf.unset(BROADCAST_SETTING)
    assert rows(warehouse, FACT_SALES) == before
    assert warehouse.parts or files_per_bucket(warehouse) == 1
