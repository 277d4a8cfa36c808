from __future__ import annotations

import uuid

import pytest

from martloom.__main__ import main, tasks
from martloom.plans.audit import layer_row_counts
from martloom.plans.refresh import refresh
from martloom.schemas import BRONZE
from martloom.sources.csv_files import read_folder
from martloom.sources.warehouse import Warehouse
from tests import samples


def test_single_tasks_in_order_do_what_the_whole_chain_does(spark, tmp_path):
    source = samples.write(tmp_path / "in")
    stepwise, whole = (f"t{uuid.uuid4().hex[:8]}" for _ in range(2))
    one = Warehouse(spark, stepwise, str(tmp_path / "wh"))
    names = list(tasks(one, source, None))
    assert len(names) == 14
    common = ["--source", source, "--catalog", stepwise, "--root", str(tmp_path / "wh")]
    main(common + [part for name in names for part in ("--task", name)])
    other = Warehouse(spark, whole, str(tmp_path / "wh"))
    counts = refresh(other, read_folder(spark, source))
    assert sorted(layer_row_counts(one).collect()) == sorted(counts.collect())
    view = f"{one.database('gold')}.store_performance"
    assert spark.table(view).count() == 3


def test_whole_chain_and_wrong_calls(spark, tmp_path, capsys):
    catalog = f"t{uuid.uuid4().hex[:8]}"
    place = ["--catalog", catalog, "--root", str(tmp_path / "wh")]
    main(["--source", samples.write(tmp_path / "in"), *place, "--report", "--run-ts", "2024-06-01 00:00:00"])
    shown = capsys.readouterr().out
    assert "gold.fact_sales" in shown
    assert "TotalSales positive" in shown
    assert "rejected_rows" in shown
    for wrong in (["--task", "bronze_sale"], [], ["--latest-by", "sale=Date", "--source", "x"], ["--latest-by", "sales", "--source", "x"]):
        with pytest.raises(SystemExit):
            main(wrong)


def test_latest_by_chooses_among_rows_with_one_key(spark, tmp_path):
    source = tmp_path / "in"
    samples.write(source)
    stores = source / "stores.csv"
    header, first = stores.read_text().split("\n")[:2]
    stores.write_text(f"{header}\n{first}\n" + ",".join([*first.split(",")[:-1], "9999"]) + "\n")
    catalog = f"t{uuid.uuid4().hex[:8]}"
    call = ["--source", str(source), "--catalog", catalog, "--root", str(tmp_path / "wh"), "--task", "bronze_stores"]
    with pytest.raises(Exception, match="repeats StoreID"):
        main(call)
    main([*call, "--latest-by", "stores=SquareFootage"])
    rows = Warehouse(spark, catalog, str(tmp_path / "wh")).read(BRONZE["stores"]).collect()
    assert [r.SquareFootage for r in rows] == [9999]
