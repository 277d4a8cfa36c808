"""Parts kept in buckets: a load moves its delivery, and no row of the tables it reads."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

import pytest

from martloom.operators.upsert import upsert
from martloom.plans.layers import silver_rows
from martloom.plans.refresh import refresh
from martloom.plans.sample_run import SampleRun
from martloom.schemas import BRONZE, FACT_SALES, SILVER, TABLES
from martloom.session import bucketed_scans, shuffle_partitions
from martloom.sources.warehouse import PART, Warehouse
from tests import samples

RUNS = [f"2024-06-0{i} 00:00:00" for i in (1, 2, 3)]
HEADER = samples.SALES.splitlines()[0] + "\n"
# A changed sale that moves to another month, one that turns bad, a new one, and a known one as it was.
SECOND = HEADER + """\
A1,2024-03-02,10,P1,9,3.50,0.00,31.50,
A2,2024-02-27,10,P2,1,20.00,5.00,-1.00,SPRING
A3,2024-02-28,20,P1,4,3.50,1.00,13.00,SPRING
A9,2024-02-29,10,P3,1,3.50,0.00,3.50,OPEN
"""
# A product of older sales comes late.
PRODUCTS = samples.PRODUCTS.replace("P3,Garden,Root,,8.10", "P3,Garden,Root,Rake,8.10")


def loaded(spark, root, buckets, parts):
    made = Warehouse(spark, f"t{uuid.uuid4().hex[:8]}", str(root / f"wh{buckets}{parts}"), buckets, parts)
    refresh(made, samples.deliver(spark, root / "one"), RUNS[0])
    refresh(made, samples.deliver(spark, root / "two", sales=SECOND, products=PRODUCTS), RUNS[1])
    return made


def rows(warehouse, spec):
    return sorted(map(tuple, warehouse.read(spec).collect()), key=str)


def plan_of(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("buckets", [8, 3])
def test_the_tables_are_those_of_parts_without_buckets(spark, tmp_path, buckets):
    plain, made = loaded(spark, tmp_path, None, "month"), loaded(spark, tmp_path, buckets, "month")
    for spec in TABLES:
        assert rows(made, spec) == rows(plain, spec), spec.label
    # Each part has a file for a bucket at most.
    for spec in (BRONZE["sales"], SILVER["sales"], FACT_SALES):
        files = [unquote(f) for f in made.rows(spec).inputFiles()]
        kept = [(f.split(f"{PART}=")[1].split("/")[0], re.search(r"_(\d{5})\.", f)[1]) for f in files]
        assert len(kept) == len(set(kept)) and {int(bucket) for _, bucket in kept} <= set(range(buckets))


def test_buckets_given_to_parts_that_had_none_and_taken_away(spark, tmp_path):
    made = loaded(spark, tmp_path, None, "month")
    before = {spec.label: rows(made, spec) for spec in (BRONZE["sales"], SILVER["sales"], FACT_SALES)}
    for run, buckets in zip(RUNS[1:], (4, None), strict=True):
        now = Warehouse(spark, made.catalog, made.root, buckets, "month")
        refresh(now, samples.deliver(spark, tmp_path / "two", sales=SECOND, products=PRODUCTS), run)
        for spec in (BRONZE["sales"], SILVER["sales"], FACT_SALES):
            assert now.has_parts(spec)
            assert [r[0] for r in rows(now, spec)] == [r[0] for r in before[spec.label]]
        # What came last is dropped with the states left behind.
        named = spark.sql(f"SHOW TABLES IN {now.database('bronze')}").collect()
        assert not [r.tableName for r in named if r.tableName.endswith("_came")]


def test_a_load_moves_no_row_of_the_tables_it_reads(spark, tmp_path, capsys):
    made = loaded(spark, tmp_path, 8, "year")
    bronze, silver = made.rows(BRONZE["sales"]), made.rows(SILVER["sales"])
    source = silver_rows(bronze, "sales")
    with bucketed_scans(spark):
        text = plan_of(upsert(silver.select(*source.columns), source, "TransactionID", on_duplicate="unique", null_keys="drop"), capsys)
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_the_sample_warehouse_joins_its_sales_in_place(spark, capsys):
    run = SampleRun(spark, "/root/testdata/sf0.001")
    silver, fact = (run.warehouse.rows(spec).select("TransactionID") for spec in (SILVER["sales"], FACT_SALES))
    with bucketed_scans(spark):
        assert "Exchange" not in plan_of(silver.join(fact, "TransactionID"), capsys)


def test_the_merge_of_two_fact_tables_moves_their_dimensions_only(spark, capsys):
    text = plan_of(SampleRun(spark, "/root/testdata/sf0.001").fact_twice(), capsys)
    assert "SortMergeJoin" in text and "BroadcastExchange" in text and "Exchange hashpartitioning" not in text


def test_shuffle_partitions_are_set_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError), shuffle_partitions(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_sales_are_stored_from_small_scans(spark):
    name, seen = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(name)
    run = SampleRun(spark, "/root/testdata/sf0.001")
    run._stored = lambda df, _: seen.append(spark.conf.get(name)) or df
    assert run.silver_sales.count() > 0
    assert seen == ["16m"] and spark.conf.get(name) == before
