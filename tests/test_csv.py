from __future__ import annotations

import datetime as dt

import pytest

from martloom.sources.csv_files import load_fixture, read_entity_csv, rejected_lines
from tests import samples


def test_types_and_empty_values(spark, tmp_path):
    sales = samples.deliver(spark, tmp_path / "in")["sales"]
    assert sales.schema.simpleString() == (
        "struct<TransactionID:string,Date:date,StoreID:string,ProductID:string,Quantity:int,"
        "UnitPrice:double,DiscountAmount:double,TotalSales:double,PromotionID:string>"
    )
    first = {r.TransactionID: r for r in sales.collect()}
    assert tuple(first["A1"]) == ("A1", dt.date(2024, 2, 27), "10", "P1", 2, 3.5, 0.0, 7.0, None)
    assert first["A6"].Date is None
    assert None in first


def test_columns_are_found_by_name_and_keys_stay_text(spark, tmp_path):
    path = tmp_path / "stores.csv"
    path.write_text("Extra,SquareFootage,StoreType,Region,StoreName,StoreID\nx,12.0,Small,North,Quay,007\n")
    row = read_entity_csv(spark, str(path), "stores").collect()
    assert list(map(tuple, row)) == [("007", "Quay", "North", "Small", 12)]


def test_value_of_the_wrong_type_fails(spark, tmp_path):
    path = tmp_path / "stores.csv"
    path.write_text("StoreID,StoreName,Region,StoreType,SquareFootage\n1,Quay,North,Small,many\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_entity_csv(spark, str(path), "stores").collect()


def test_a_fraction_is_no_whole_number(spark, tmp_path):
    path = tmp_path / "stores.csv"
    path.write_text("StoreID,StoreName,Region,StoreType,SquareFootage\n1,Quay,North,Small,100.9\n")
    with pytest.raises(Exception, match="SquareFootage is no whole number: 100.9"):
        read_entity_csv(spark, str(path), "stores").collect()


def test_files_of_a_folder_must_agree_on_their_columns(spark, tmp_path):
    header = "StoreID,StoreName,Region,StoreType,SquareFootage"
    (tmp_path / "a.csv").write_text(f"{header}\n1,Quay,North,Small,1\n")
    (tmp_path / "b.csv").write_text(f"{header}\n2,Hill,South,Large,2\n")
    assert sorted(r.StoreID for r in read_entity_csv(spark, str(tmp_path), "stores").collect()) == ["1", "2"]
    (tmp_path / "b.csv").write_text("StoreName,StoreID,Region,StoreType,SquareFootage\nHill,2,South,Large,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_entity_csv(spark, str(tmp_path), "stores").collect()


def test_fixture_loader(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,\n2,b\n")
    assert sorted(map(tuple, load_fixture(spark, str(tmp_path / "a.csv")).collect())) == [("1", ""), ("2", "b")]
    (tmp_path / "b.json").write_text('[{"id": 1, "text": "a"},\n {"id": 2, "text": null}]')
    assert sorted(map(tuple, load_fixture(spark, str(tmp_path / "b.json")).collect())) == [(1, "a"), (2, None)]
    with pytest.raises(ValueError):
        load_fixture(spark, str(tmp_path / "c.xml"))


def test_bad_lines_are_listed_left_out_or_fail(spark, tmp_path):
    header = "StoreID,StoreName,Region,StoreType,SquareFootage"
    (tmp_path / "a.csv").write_text(f'{header}\n1,"Quay, new",North,Small,1\n2,Hill\n3,Hill,South,Large,3,4,5\n')
    (tmp_path / "b.csv").write_text(f"{header}\n4,Moor,South,Large,many\n5,Moor,South,Large,1.5\n6,,,,\n7,Dale,South,Large,2.0\n")
    found = {r.line.split(",")[0]: (r.file[-5:], r.reason) for r in rejected_lines(spark, str(tmp_path), "stores").collect()}
    wrong = ("b.csv", "SquareFootage is no int")
    assert found == {"2": ("a.csv", "too few values"), "3": ("a.csv", "too many values"), "4": wrong, "5": wrong}
    kept = read_entity_csv(spark, str(tmp_path), "stores", bad_lines="reject").collect()
    assert sorted((r.StoreID, r.StoreName, r.SquareFootage) for r in kept) == [("1", "Quay, new", 1), ("6", None, None), ("7", "Dale", 2)]
    with pytest.raises(Exception, match="line does not fit the header: .*a.csv: (2,Hill|3,Hill,South,Large,3,4,5)"):
        read_entity_csv(spark, str(tmp_path / "a.csv"), "stores", bad_lines="fail").collect()
    both = read_entity_csv(spark, str(tmp_path / "a.csv"), "stores").orderBy("StoreID").collect()
    assert [(r.StoreID, r.Region, r.SquareFootage) for r in both] == [("1", "North", 1), ("2", None, None), ("3", "South", 3)]
    with pytest.raises(ValueError, match="keep, reject, fail"):
        read_entity_csv(spark, str(tmp_path), "stores", bad_lines="drop")
