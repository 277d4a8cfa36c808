"""Time the loads, lookups and views over many sales, a third of them in one store; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1), ``BENCH_CPUS`` the local cores,
``BENCH_COPIES`` how often every delivered sale comes, each time under another TransactionID (default 15).
"""

from __future__ import annotations

import json
import os
import time
from dataclasses import replace

from pyspark.sql import functions as F

from bench import session
from martloom.operators.lookup import lookup
from martloom.plans.refresh import load_bronze, load_fact, load_silver, read_star, refresh
from martloom.plans.views import VIEWS, view
from martloom.schemas import DIM_STORE, ENTITIES, SILVER
from martloom.session import scratch_path
from martloom.sources.sample_tables import sales_order, sample_delivery
from martloom.sources.warehouse import Warehouse


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("BENCH_COPIES", "15"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    warehouse = Warehouse(spark, "bench", scratch_path(spark, "warehouse"), 16)
    deliveries = {e: sample_delivery(spark, folder, e) for e in ENTITIES}
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")
    sales = deliveries["sales"].select("*", copy).withColumns(
        {
            "TransactionID": F.concat_ws("-", "TransactionID", "copy"),
            "StoreID": F.when(F.col("copy") % 3 == 0, F.lit("S1")).otherwise(F.col("StoreID")),
        }
    )
    deliveries["sales"] = sales.filter("TransactionID LIKE '%-%-%'").drop("copy")
    seconds: dict[str, float] = {}

    def timed(name: str, job) -> None:
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 2)

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    timed("everything, first", lambda: refresh(warehouse, deliveries, None, {"sales": sales_order()}))
    timed("bronze sales, second", lambda: load_bronze(warehouse, "sales", deliveries["sales"], None, sales_order()))
    timed("silver sales, second", lambda: load_silver(warehouse, "sales"))
    timed("fact, second", lambda: load_fact(warehouse))
    star = read_star(warehouse)
    for name in VIEWS:
        timed(name, lambda v=name: run(view(v, star)))
        timed(f"{name}, any fact", lambda v=name: run(view(v, replace(star, maintained=False))))
    silver, store = warehouse.read(SILVER["sales"]), warehouse.read(DIM_STORE)
    for how, limit in (("broadcast", None), ("spread", 0)):
        timed(f"store lookup, {how}", lambda n=limit: run(lookup(silver, store, "StoreID", ["StoreKey"], "TransactionID", n)))
    # What one more day costs, in a warehouse that rewrites its tables and in one that keeps them in parts.
    one_day = deliveries | {"sales": sales.filter("Date = DATE '1998-01-05' AND TransactionID LIKE '%-%-%'").drop("copy")}
    in_parts = Warehouse(spark, "bench_parts", scratch_path(spark, "warehouse"), parts="month")
    timed("everything, first, in months", lambda: refresh(in_parts, deliveries, None, {"sales": sales_order()}))
    for name, made in (("buckets", warehouse), ("months", in_parts)):
        timed(f"one day more, in {name}", lambda w=made: refresh(w, one_day, None, {"sales": sales_order()}))
    print(json.dumps({"sales": sales.count(), "seconds": seconds}))
    spark.stop()


if __name__ == "__main__":
    main()
