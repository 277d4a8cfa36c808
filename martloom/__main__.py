"""Run the chain, or one task of it, from a folder of CSV files.

    spark-submit --py-files martloom.zip martloom/__main__.py --source hdfs:///retail-in --catalog retail_dev
    python -m martloom --source ./retail-in --root ./warehouse --task bronze_sales
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from martloom.plans.audit import quality_report, rejected_rows
from martloom.plans.refresh import (
    load_bronze,
    load_dim_date,
    load_dimension,
    load_fact,
    load_silver,
    refresh,
)
from martloom.plans.views import publish_views
from martloom.schemas import BRONZE, DIMENSIONS, ENTITIES
from martloom.session import tune
from martloom.sources.csv_files import read_entity_csv, read_folder
from martloom.sources.warehouse import Warehouse


def latest_by(chosen: list[str]) -> dict[str, list[Column]]:
    """Orders from arguments such as ``sales=Date,Quantity``: of rows that share a key, that of the highest counts."""
    pairs = (x.partition("=") for x in chosen)
    return {entity: [F.desc(c) for c in columns.split(",") if c] for entity, _, columns in pairs}


def tasks(
    warehouse: Warehouse, source: str | None, run_ts: str | None, order_by: dict[str, list[Column]] | None = None
) -> dict[str, Callable[[], None]]:
    """The single tasks in an order in which each finds what it reads."""

    def bronze(entity: str) -> None:
        delivery = read_entity_csv(warehouse.spark, f"{source}/{entity}.csv", entity)
        load_bronze(warehouse, entity, delivery, run_ts, (order_by or {}).get(entity, ()))

    named: dict[str, Callable[[], None]] = {}
    for entity in ENTITIES:
        named[f"bronze_{entity}"] = lambda e=entity: bronze(e)
    for entity in ENTITIES:
        named[f"silver_{entity}"] = lambda e=entity: load_silver(warehouse, e, run_ts)
    named["gold_dim_date"] = lambda: load_dim_date(warehouse)
    for entity, spec in DIMENSIONS.items():
        named[f"gold_{spec.name}"] = lambda e=entity: load_dimension(warehouse, e, run_ts)
    named["gold_fact_sales"] = lambda: load_fact(warehouse, run_ts)
    named["gold_analytics_views"] = lambda: publish_views(warehouse)
    return named


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="martloom", description=__doc__.splitlines()[0])
    parser.add_argument("--source", help="folder with sales.csv, products.csv, stores.csv and promotions.csv")
    parser.add_argument("--catalog", default="retail_dev", help="prefix of the layer databases")
    parser.add_argument("--root", help="folder of the databases; default: the warehouse folder of the session")
    parser.add_argument("--buckets", type=int, help="buckets of the sales tables; default: shuffle partitions")
    parser.add_argument(
        "--parts", choices=["day", "month", "year"], help="keep the sales tables in parts of this length instead of buckets"
    )
    parser.add_argument("--run", help="name of the delivery; a run that failed goes on under the same name")
    parser.add_argument("--run-ts", help="time written to the audit columns; default: now")
    parser.add_argument("--report", action="store_true", help="also show the rows that lack a key or break a rule")
    parser.add_argument(
        "--latest-by",
        action="append",
        default=[],
        metavar="ENTITY=COLUMN,...",
        help="of rows with one key, load the one highest in these columns; default: repeated keys fail",
    )
    parser.add_argument("--task", action="append", help="run only this task; may be repeated")
    chosen = parser.parse_args(arguments)

    order_by = latest_by(chosen.latest_by)
    wrong = set(order_by) - set(ENTITIES) | {e for e, columns in order_by.items() if not columns}
    if wrong:
        parser.error(f"--latest-by needs an entity and columns, not {', '.join(sorted(wrong))}")
    spark = tune(SparkSession.builder.appName("martloom").getOrCreate())
    warehouse = Warehouse(spark, chosen.catalog, chosen.root, chosen.buckets, chosen.parts)
    if chosen.task:
        named = tasks(warehouse, chosen.source, chosen.run_ts, order_by)
        unknown = set(chosen.task) - set(named)
        if unknown:
            parser.error(f"no task {', '.join(sorted(unknown))}; tasks are {', '.join(named)}")
        for task in chosen.task:
            named[task]()
    elif chosen.source:
        refresh(warehouse, read_folder(spark, chosen.source), chosen.run_ts, order_by, chosen.run).show(truncate=False)
    else:
        parser.error("--source is needed to run the whole chain")
    if chosen.report and chosen.source:
        rejected_rows(read_folder(spark, chosen.source)).show(truncate=False)
    if chosen.report:
        quality_report({e: warehouse.read(spec) for e, spec in BRONZE.items()}).show(truncate=False)


if __name__ == "__main__":
    main()
