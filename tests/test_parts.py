"""Sales tables kept in parts: what a load reads and writes, and what readers see while it runs."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

import pytest

from martloom.plans import refresh as loads
from martloom.plans.refresh import changed_rows, load_bronze, load_silver, merge_into, refresh
from martloom.schemas import BRONZE, DIM_STORE, FACT_SALES, SILVER, TABLES
from martloom.sources.csv_files import read_entity_csv
from martloom.sources.warehouse import PART, Warehouse
from tests import samples

RUN_1, RUN_2, RUN_3 = (f"2024-06-0{i} 00:00:00" for i in (1, 2, 3))
HEADER = samples.SALES.splitlines()[0] + "\n"
GROWING = (BRONZE["sales"], SILVER["sales"], FACT_SALES)
KEPT = {e: getattr(samples, e.upper()) for e in ("products", "stores", "promotions")}


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"t{uuid.uuid4().hex[:8]}", str(tmp_path / "wh"), parts="day")


def files(warehouse, spec) -> dict[str, set[str]]:
    found: dict[str, set[str]] = {}
    for file in warehouse.rows(spec).inputFiles():
        found.setdefault(unquote(file).split(f"{PART}=")[1].split("/")[0], set()).add(file)
    return found


def rows(warehouse, spec):
    return sorted(map(tuple, warehouse.read(spec).collect()), key=str)


def rows_scanned(df) -> int:
    """What the scans of a query gave to the next step, as Spark counted it."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_delivery_of_one_day_writes_that_day_only(spark, warehouse, tmp_path):
    refresh(warehouse, samples.deliver(spark, tmp_path / "one"), RUN_1)
    before = {spec.label: files(warehouse, spec) for spec in GROWING}
    assert set(before["gold.fact_sales"]) == {"2024-02-27", "2024-02-28", "2024-03-01"}
    sales = HEADER + "A3,2024-02-28,20,P1,5,3.50,0.00,17.50,\nA8,2024-02-28,10,P1,1,3.50,0.00,3.50,\n"
    refresh(warehouse, samples.deliver(spark, tmp_path / "two", sales=sales, **KEPT), RUN_2)
    for spec in GROWING:
        after = files(warehouse, spec)
        assert set(after) == set(before[spec.label])
        assert {part for part in after if after[part] != before[spec.label][part]} == {"2024-02-28"}


def test_a_sale_that_moves_takes_its_former_day_along(spark, warehouse, tmp_path):
    refresh(warehouse, samples.deliver(spark, tmp_path / "one"), RUN_1)
    before = files(warehouse, BRONZE["sales"])
    sales = HEADER + "A3,2024-05-05,20,P1,5,3.50,0.00,17.50,\n"
    refresh(warehouse, samples.deliver(spark, tmp_path / "two", sales=sales, **KEPT), RUN_2)
    after = files(warehouse, BRONZE["sales"])
    assert after["2024-02-27"] == before["2024-02-27"] and "2024-05-05" in after
    for spec in GROWING:
        assert [str(r[1]) for r in warehouse.read(spec).select(spec.key, spec.day).collect() if r[0] == "A3"] == ["2024-05-05"]


def test_the_next_load_reads_what_changed(spark, warehouse, tmp_path):
    refresh(warehouse, samples.deliver(spark, tmp_path / "one"), RUN_1)
    days = HEADER + "".join(f"N{i},2024-07-{1 + i % 20:02d},10,P1,1,3.50,0.00,3.50,\n" for i in range(400))
    refresh(warehouse, samples.deliver(spark, tmp_path / "two", sales=days, **KEPT), RUN_2)
    for reader, source in ((SILVER["sales"], BRONZE["sales"]), (FACT_SALES, SILVER["sales"])):
        changed, _ = changed_rows(warehouse, reader, source)
        assert changed.count() == 0
    path = tmp_path / "three.csv"
    path.write_text(HEADER + "N0,2024-07-01,10,P1,2,3.50,0.00,7.00,\n")
    load_bronze(warehouse, "sales", read_entity_csv(spark, str(path), "sales"), RUN_3)
    changed, _ = changed_rows(warehouse, SILVER["sales"], BRONZE["sales"])
    assert [r.TransactionID for r in changed.collect()] == ["N0"]
    # Files of the other days are skipped by their footers: one day has 20 rows.
    assert rows_scanned(changed) <= 20 < warehouse.read(BRONZE["sales"]).count()


def test_late_members_are_found_without_reading_the_rest(spark, warehouse, tmp_path, monkeypatch):
    refresh(warehouse, samples.deliver(spark, tmp_path / "one"), RUN_1)
    looked_up: list[int] = []
    real = loads.fact_rows
    monkeypatch.setattr(loads, "fact_rows", lambda sales, *rest: (looked_up.append(sales.count()), real(sales, *rest))[1])
    products = samples.PRODUCTS.splitlines()[0] + "\nP3,Garden,Root,Rake,8.10\n"
    arrivals = {"sales": HEADER, "products": products, "stores": KEPT["stores"], "promotions": KEPT["promotions"]}
    refresh(warehouse, samples.deliver(spark, tmp_path / "two", **arrivals), RUN_2)
    found = {r.TransactionID: r.ProductKey for r in warehouse.read(FACT_SALES).collect()}
    assert found["A4"] == 3 and looked_up == [1]
    refresh(warehouse, samples.deliver(spark, tmp_path / "three", **arrivals), RUN_3)
    assert looked_up == [1, 0]


def test_time_of_validation_follows_the_last_load_for_rows_that_are_still_good(spark, warehouse, tmp_path):
    refresh(warehouse, samples.deliver(spark, tmp_path / "one"), RUN_1)
    bad = HEADER + "A1,2024-02-27,10,P1,2,3.50,7.00,0.00,\n"
    refresh(warehouse, samples.deliver(spark, tmp_path / "two", sales=bad, **KEPT), RUN_2)
    refresh(warehouse, samples.deliver(spark, tmp_path / "three", sales=HEADER, **KEPT), RUN_3)
    stamps = {r.TransactionID: str(r._validated_at)[:10] for r in warehouse.read(SILVER["sales"]).collect()}
    assert stamps.pop("A1") == "2024-06-01" and set(stamps.values()) == {"2024-06-03"}
    good = HEADER + "A1,2024-02-27,10,P1,2,3.50,0.00,7.00,\n"
    refresh(warehouse, samples.deliver(spark, tmp_path / "four", sales=good, **KEPT), "2024-06-04 00:00:00")
    assert {str(r._validated_at)[:10] for r in warehouse.read(SILVER["sales"]).collect()} == {"2024-06-04"}


def test_files_that_no_state_has_are_dropped(spark, warehouse, tmp_path):
    for i in range(3):
        refresh(warehouse, samples.deliver(spark, tmp_path / str(i)), RUN_1)
    for spec in GROWING:
        place = urlparse(spark.catalog.getDatabase(warehouse.database(spec.layer)).locationUri).path
        tables = [x for x in os.listdir(place) if x.startswith(f"{spec.name}__")]
        assert len(tables) == 2  # the files of this state and of the one before
        held = [f for x in tables for f in os.listdir(f"{place}/{x}") if f.startswith(PART)]
        assert len(held) == 2 * len(files(warehouse, spec))


def test_a_refresh_that_fails_shows_nothing_and_goes_on_where_it_was(spark, warehouse, tmp_path, monkeypatch):
    refresh(warehouse, samples.deliver(spark, tmp_path / "one"), RUN_1)
    name = f"{warehouse.database('gold')}.store_performance"
    before, tables = sorted(map(str, spark.table(name).collect())), {s.label: rows(warehouse, s) for s in TABLES}
    sales = HEADER + "A9,2024-03-03,05,P1,1,9.00,0.00,9.00,\n"
    stores = samples.STORES.splitlines()[0] + "\n05,First,North,Small,100\n"
    delivery = samples.deliver(spark, tmp_path / "two", sales=sales, products=KEPT["products"], stores=stores, promotions=KEPT["promotions"])
    with monkeypatch.context() as broken:
        broken.setattr(loads, "load_fact", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped before the fact table")))
        with pytest.raises(RuntimeError, match="stopped"):
            refresh(warehouse, delivery, RUN_2, run="june 2")
    # New dimensions are made, but nobody sees them beside the old fact table.
    assert {s.label: rows(warehouse, s) for s in TABLES} == tables
    assert sorted(map(str, spark.table(name).collect())) == before
    again = Warehouse(spark, warehouse.catalog, warehouse.root, parts="day")
    with monkeypatch.context() as counted:
        for load in ("load_bronze", "load_silver", "load_dim_date", "load_dimension"):
            counted.setattr(loads, load, lambda *_, n=load: pytest.fail(f"{n} was done before"))
        refresh(again, delivery, RUN_2, run="june 2")
    fact = {r.TransactionID: r for r in again.read(FACT_SALES).collect()}
    assert fact["A9"].StoreKey == 3 and {r.StoreID for r in again.read(DIM_STORE).collect()} == {"05", "10", "20"}
    assert sorted(map(str, spark.table(name).collect())) != before


def test_states_of_another_run_are_dropped(spark, warehouse, tmp_path, monkeypatch):
    delivery = samples.deliver(spark, tmp_path / "one")
    with monkeypatch.context() as broken:
        broken.setattr(loads, "load_fact", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            refresh(warehouse, delivery, RUN_1, run="first")
    assert not warehouse.exists(BRONZE["sales"])
    refresh(warehouse, delivery, RUN_2, run="second")
    assert {str(r._loaded_at)[:10] for r in warehouse.read(BRONZE["sales"]).collect()} == {"2024-06-02"}


def test_from_buckets_to_parts_of_other_lengths_and_back(spark, warehouse, tmp_path):
    delivery, before = samples.deliver(spark, tmp_path / "in"), None
    for parts in (None, "day", "month", None):
        now = Warehouse(spark, warehouse.catalog, warehouse.root, parts=parts)
        refresh(now, delivery, RUN_1)
        assert before in (None, [rows(now, s) for s in TABLES])
        before = [rows(now, s) for s in TABLES]
        assert all(now.has_parts(s) == (parts is not None) for s in GROWING)
    with pytest.raises(ValueError, match="day, month or year"):
        Warehouse(spark, parts="week")
    with pytest.raises(ValueError, match="not kept in parts"):
        Warehouse(spark, warehouse.catalog, parts="day").replace_parts(FACT_SALES, now.read(FACT_SALES), [])


def test_sales_without_a_day_have_a_part(spark, warehouse, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(HEADER + "B1,,10,P1,1,1.00,0.00,1.00,\nB2,2024-01-01,10,P1,1,1.00,0.00,1.00,\n")
    load_bronze(warehouse, "sales", read_entity_csv(spark, str(path), "sales"), RUN_1)
    load_silver(warehouse, "sales", RUN_1)
    assert set(files(warehouse, BRONZE["sales"])) == {"none", "2024-01-01"}
    merge_into(warehouse, BRONZE["sales"], warehouse.read(BRONZE["sales"]).limit(0))
    assert warehouse.read(BRONZE["sales"]).count() == 2 and warehouse.read(SILVER["sales"]).count() == 1
