"""What the physical plans must and must not contain."""

from __future__ import annotations

import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from martloom.functions.calendar import date_spine
from martloom.operators.keys import dense_key
from martloom.operators.quality import quality_counts, rules_for
from martloom.operators.upsert import dedupe_latest, upsert
from martloom.plans.audit import layer_row_counts
from martloom.plans.layers import fact_rows, silver_rows, star_check
from martloom.plans.refresh import read_star, refresh
from martloom.plans.sample_run import SampleRun
from martloom.plans.views import VIEWS, top, view
from martloom.schemas import BRONZE, DIM_DATE, DIM_PRODUCT, DIM_PROMOTION, DIM_STORE, FACT_SALES, SILVER, TABLES
from martloom.session import bucketed_scans
from martloom.sources.footers import footers
from martloom.sources.warehouse import Warehouse
from tests import samples


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    made = Warehouse(spark, f"t{uuid.uuid4().hex[:8]}", str(root / "wh"))
    refresh(made, samples.deliver(spark, root / "in"))
    return made


@pytest.fixture
def plan(capsys):
    def explained(df, mode="simple"):
        capsys.readouterr()
        df.explain(mode)
        return capsys.readouterr().out

    return explained


def test_silver_merge_moves_and_sorts_nothing(warehouse, plan):
    source = silver_rows(warehouse.read(BRONZE["sales"]), "sales")
    with bucketed_scans(warehouse.spark):
        text = plan(upsert(warehouse.read(SILVER["sales"]), source, "TransactionID", null_keys="drop"))
    assert "SortMergeJoin" in text
    assert "Exchange" not in text
    assert "Sort " not in text


def test_fact_merge_moves_no_sale(warehouse, plan):
    facts = fact_rows(
        warehouse.read(SILVER["sales"]),
        *(warehouse.read(spec) for spec in (DIM_STORE, DIM_PRODUCT, DIM_PROMOTION, DIM_DATE)),
    )
    with bucketed_scans(warehouse.spark):
        text = plan(upsert(warehouse.read(FACT_SALES), facts, "TransactionID", ["_created_at"], null_keys="drop"))
    assert text.count("BroadcastHashJoin") == 4
    assert text.count("Exchange") == text.count("BroadcastExchange") == 4


def test_silver_rules_reach_the_scan(warehouse, plan):
    text = plan(silver_rows(warehouse.read(BRONZE["sales"]), "sales"), "formatted")
    pushed = text.split("PushedFilters: [")[1].split("\n")[0]
    for rule in ("IsNotNull(TransactionID)", "IsNotNull(Date)", "GreaterThan(TotalSales,0.0)"):
        assert rule in pushed


def test_views_read_only_their_columns_and_move_only_groups(warehouse, plan):
    text = plan(view("sales_trend_by_month", read_star(warehouse)), "formatted")
    assert "ReadSchema: struct<TransactionID:string,DateKey:date,Quantity:int,TotalSales:double>" in text
    assert "ReadSchema: struct<DateKey:date,Year:int,Month:int,MonthName:string>" in text
    text = plan(view("store_performance", read_star(warehouse)))
    # Sums are made before any exchange of the fact, and the store joins after the last grouping.
    assert facts_are_summed_before_any_exchange(text)
    assert text.index("Join") < text.index("HashAggregate")
    assert "Expand" not in text


def facts_are_summed_before_any_exchange(text: str) -> bool:
    """Above every scan of the fact table the next node that is no filter or projection is a partial sum."""
    lines = text.split("\n")
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "fact_sales" in line]
    above = [next(x for x in reversed(lines[:i]) if not any(n in x for n in ("Filter", "Project", "ColumnarToRow"))) for i in scans]
    return bool(scans) and all("HashAggregate" in x and "partial_" in x or "functions=[]" in x for x in above)


@pytest.mark.parametrize("maintained", [True, False])
@pytest.mark.parametrize("name", VIEWS)
def test_nothing_is_expanded_to_count_different_keys(warehouse, plan, name, maintained):
    assert "Expand" not in plan(view(name, replace(read_star(warehouse), maintained=maintained)))


@pytest.mark.parametrize("name", VIEWS)
def test_any_fact_is_summed_before_any_exchange(warehouse, plan, name):
    star = replace(read_star(warehouse), maintained=False)
    assert facts_are_summed_before_any_exchange(plan(view(name, star)))


def test_star_check_looks_up_no_more_than_it_shows(warehouse, plan):
    text = plan(star_check(read_star(warehouse)))
    assert text.index("Join") < text.index("TakeOrderedAndProject", text.index("Join")) < text.index("fact_sales")


def test_stale_rows_take_one_join_of_two_scans(spark, plan):
    text = plan(SampleRun(spark, "/root/testdata/sf0.001").stale_sales())
    assert text.count("FileScan") == 2 and text.count("Join") == 1 and "Exchange SinglePartition" not in text


def test_unused_buckets_do_not_bound_the_tasks_of_a_view(warehouse, plan):
    text = plan(view("sales_trend_by_month", read_star(warehouse)), "formatted")
    assert "Bucketed: false (disabled by query planner)" in text


def test_top_is_taken_without_a_full_sort(warehouse, plan):
    text = plan(top("store_performance", read_star(warehouse)))
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


def test_hot_key_is_reduced_before_the_shuffle(spark, plan):
    df = spark.range(10).select((F.col("id") % 2).cast("string").alias("key"), "id")
    text = plan(dedupe_latest(df, "key", [F.desc("id")], null_keys="drop"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_dense_key_sorts_no_row_in_a_single_task(spark, plan):
    text = plan(dense_key(spark.range(100).select(F.col("id").cast("string").alias("code")), "code", "key"))
    # The single task only adds up the sizes of the ranges.
    above, below = text.split("Exchange SinglePartition")
    assert "Window" in above and "HashAggregate" in below
    assert text.count("SinglePartition") == 1


def test_counts_and_extremes_come_from_footers(warehouse, plan):
    text = plan(layer_row_counts(warehouse))
    assert text.count("PushedAggregation: [COUNT(*)]") == len(TABLES) and "FileScan" not in text
    spine = date_spine(footers(warehouse.read(SILVER["sales"])), "Date")
    assert "PushedAggregation: [MIN(Date), MAX(Date)]" in plan(spine)
    assert spine.count() == 4
    # Other reads are as they were.
    assert "FileScan" in plan(warehouse.read(SILVER["sales"]))


def test_quality_is_counted_in_one_scan(warehouse, plan):
    assert plan(quality_counts(warehouse.read(BRONZE["sales"]), rules_for("sales"))).count("FileScan") == 1


def test_sales_tables_have_one_file_per_bucket(spark, warehouse, tmp_path):
    refresh(warehouse, samples.deliver(spark, tmp_path / "again"))
    for spec in (BRONZE["sales"], SILVER["sales"], FACT_SALES):
        files = warehouse.read(spec).inputFiles()
        assert len(files) <= warehouse.buckets
        buckets = [f.rsplit("_", 1)[1] for f in files]
        assert len(set(buckets)) == len(buckets)
