"""The layers over the sample deliveries, as one load and as two successive ones.

What several results are read from (silver sales, the fact table) is written once per
application to the shared folder, as it would be in a warehouse.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import cache, cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.keys import scd1_dimension
from martloom.operators.lookup import BROADCAST_SETTING
from martloom.operators.quality import rules_for
from martloom.operators.upsert import dedupe_latest, upsert
from martloom.plans.layers import (
    NO_PROMOTION,
    Star,
    bronze_rows,
    dim_date_rows,
    dimension_members,
    fact_rows,
    silver_rows,
)
from martloom.plans.refresh import refresh
from martloom.schemas import BRONZE, DIMENSIONS, ENTITIES, ENTITY_KEY, FACT_SALES
from martloom.session import scratch_path, shuffle_partitions, small_scans, together
from martloom.sources.csv_files import load_fixture, read_entity_csv, rejected_lines
from martloom.sources.footers import footers
from martloom.sources.sample_tables import sales_order, sample_delivery
from martloom.sources.warehouse import Warehouse

# The load times of the first (or only) and of the second run.
FIRST_RUN, SECOND_RUN = "2024-06-01 00:00:00", "2024-06-02 00:00:00"
# Order lines to a bucket of the warehouse, and the fewest buckets.
BUCKET_ROWS, LEAST_BUCKETS = 500_000, 8


class SampleRun:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def delivery(self, entity: str, part: int | None = None) -> DataFrame:
        return sample_delivery(self.spark, self.folder, entity, part)

    def order(self, entity: str) -> list:
        return sales_order() if entity == "sales" else []

    def through_csv(self, entity: str) -> DataFrame:
        """A delivery written as a header-row CSV file and read back."""
        path = scratch_path(self.spark, f"{entity}-csv")
        self._one_per_key(self.delivery(entity), entity).select(*self._columns(entity)).write.csv(path, header=True)
        return read_entity_csv(self.spark, path, entity)

    def damaged_csv(self) -> str:
        """Sales as header-row CSV files in which lines are cut short, carry a surplus value or a wrong one."""
        path, columns = scratch_path(self.spark, "damaged-csv"), self._columns("sales")
        rows = self._one_per_key(self.delivery("sales"), "sales").select(*columns)
        text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns}
        line = F.concat_ws(",", *text.values())
        damaged = (
            F.when(F.col("Quantity") == 7, F.concat(line, F.lit(",surplus")))
            .when(F.col("Quantity") == 13, F.concat_ws(",", *list(text.values())[:3]))
            .when(F.col("Quantity") == 29, F.concat_ws(",", *(text | {"Quantity": F.lit("many")}).values()))
            .otherwise(line)
        )
        files = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        lines = rows.select(F.pmod(F.xxhash64("TransactionID"), F.lit(files)).alias("file"), F.lit(1).alias("at"), damaged.alias("value"))
        headers = self.spark.range(files).select(F.col("id").alias("file"), F.lit(0).alias("at"), F.lit(",".join(columns)).alias("value"))
        dealt = lines.union(headers).repartition("file").sortWithinPartitions("file", "at").select("file", "value")
        dealt.write.partitionBy("file").text(path)
        return f"{path}/*"

    def rejected_lines(self) -> DataFrame:
        """Lines of a damaged delivery that are left out, by reason."""
        key = F.split_part("line", F.lit(","), F.lit(1))
        found = rejected_lines(self.spark, self.damaged_csv(), "sales").groupBy("reason")
        return found.agg(F.count("*").alias("line_count"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))

    def read_past_bad_lines(self) -> DataFrame:
        return read_entity_csv(self.spark, self.damaged_csv(), "sales", bad_lines="reject")

    def fixture(self, entity: str) -> DataFrame:
        """A delivery as a small test input: all text, nothing NULL."""
        path = scratch_path(self.spark, entity) + ".csv"
        self.delivery(entity).select(*self._columns(entity)).write.csv(path, header=True)
        return load_fixture(self.spark, path)

    # One load of everything.

    def bronze(self, entity: str, part: int | None = None) -> DataFrame:
        rows = bronze_rows(self.delivery(entity, part), entity, FIRST_RUN)
        return self._one_per_key(rows, entity).select(*BRONZE[entity].columns)

    def silver(self, entity: str, part: int | None = None) -> DataFrame:
        return silver_rows(self.bronze(entity, part), entity, FIRST_RUN)

    @cached_property
    def silver_sales(self) -> DataFrame:
        with small_scans(self.spark):
            return self._stored(self.silver("sales"), "silver-sales")

    def dim_date(self) -> DataFrame:
        return dim_date_rows(self.silver_sales)

    def dimension(self, entity: str, part: int | None = None) -> DataFrame:
        spec = DIMENSIONS[entity]
        members = dimension_members(self.silver(entity, part), entity, FIRST_RUN)
        return scd1_dimension(None, members, spec.key, spec.surrogate).select(*spec.columns)

    @cached_property
    def star(self) -> Star:
        dims = together(lambda e: self._stored(self.dimension(e), DIMENSIONS[e].name), DIMENSIONS)
        date = self._stored(self.dim_date(), "dim-date")
        fact = fact_rows(
            self.silver_sales, dims["stores"], dims["products"], dims["promotions"], date, FIRST_RUN
        )
        return Star(
            self._stored(fact, "fact-sales"),
            date,
            dims["stores"],
            dims["products"],
            dims["promotions"],
            maintained=True,
        )

    def fact_spread(self) -> DataFrame:
        """The fact table with no dimension small enough to broadcast."""
        self.spark.conf.set(BROADCAST_SETTING, "0")
        try:
            star = self.star
            return fact_rows(self.silver_sales, star.store, star.product, star.promotion, star.date, FIRST_RUN)
        finally:
            self.spark.conf.unset(BROADCAST_SETTING)

    def any_star(self) -> Star:
        """The star with whole orders as transactions, which repeat, and some keys that no dimension has."""
        lost = F.col("Quantity") % 10
        fact = self.star.fact.withColumns(
            {
                "TransactionID": F.split_part("TransactionID", F.lit("-"), F.lit(1)),
                "DateKey": F.when(lost == 3, F.date_add("DateKey", 36500)).otherwise(F.col("DateKey")),
                "StoreKey": F.when(lost == 7, F.col("StoreKey") + 1000000 + F.col("Quantity")).otherwise(F.col("StoreKey")),
                "ProductKey": F.when(lost == 5, F.col("ProductKey") + 1000000).otherwise(F.col("ProductKey")),
                "PromotionKey": F.when((lost == 9) & (F.col("PromotionKey") != NO_PROMOTION), F.col("PromotionKey") + 1000000)
                .otherwise(F.col("PromotionKey")),
            }
        )
        return replace(self.star, fact=fact, maintained=False)

    # Two successive loads.

    @cached_property
    def _first_sales(self) -> DataFrame:
        """Bronze sales after the first load, which the second one starts from."""
        return self._in_buckets(self.bronze("sales", 1).repartition(self._buckets, "TransactionID"), "bronze_sales")

    def bronze_first(self, entity: str) -> DataFrame:
        return self._first_sales if entity == "sales" else self.bronze(entity, 1)

    def silver_first(self, entity: str) -> DataFrame:
        return silver_rows(self.bronze_first(entity), entity, FIRST_RUN)

    @cached_property
    def _second_sales(self) -> DataFrame:
        # As merged with rows in buckets, the rows are grouped like them.
        return self._in_buckets(self.silver_twice("sales"), "silver_sales")

    def bronze_twice(self, entity: str) -> DataFrame:
        order = self.order(entity)
        return upsert(
            self.bronze_first(entity),
            bronze_rows(self.delivery(entity, 2), entity, SECOND_RUN),
            ENTITY_KEY[entity],
            on_duplicate="latest" if order else "error",
            order_by=order,
            null_keys="drop",
        )

    def silver_twice(self, entity: str) -> DataFrame:
        return upsert(
            self.silver_first(entity),
            silver_rows(self.bronze_twice(entity), entity, SECOND_RUN),
            ENTITY_KEY[entity],
            null_keys="drop",
        )

    def stale_sales(self) -> DataFrame:
        """Silver sales whose latest version no longer meets the rules: they keep their old state."""
        delivered = self._one_per_key(bronze_rows(self.delivery("sales", 2), "sales", SECOND_RUN), "sales")
        met = reduce(Column.__and__, rules_for("sales").values())
        failing = delivered.filter(~F.coalesce(met, F.lit(False))).select("TransactionID")
        return self.silver_first("sales").join(failing, "TransactionID", "left_semi")

    def dimension_twice(self, entity: str, first: DataFrame | None = None) -> DataFrame:
        spec = DIMENSIONS[entity]
        if first is None:
            first = self.dimension(entity, 1)
        members = dimension_members(self.silver_twice(entity), entity, SECOND_RUN)
        return scd1_dimension(first, members, spec.key, spec.surrogate).select(*spec.columns)

    def fact_twice(self) -> DataFrame:
        def fact(sales: DataFrame, dims: dict[str, DataFrame], run_ts: str) -> DataFrame:
            date = dim_date_rows(sales)
            return fact_rows(sales, dims["stores"], dims["products"], dims["promotions"], date, run_ts)

        first_sales, second_sales = self.silver_first("sales"), self._second_sales
        # Stored, so that their size is known where they are joined.
        first_dims = together(lambda e: self._stored(self.dimension(e, 1), DIMENSIONS[e].name), DIMENSIONS)
        second_dims = together(lambda e: self._stored(self.dimension_twice(e, first_dims[e]), DIMENSIONS[e].name), DIMENSIONS)
        first = fact(first_sales, first_dims, FIRST_RUN)
        second = fact(second_sales, second_dims, SECOND_RUN)
        return upsert(first, second, FACT_SALES.key, preserve=[FACT_SALES.stamp], null_keys="drop")

    @cached_property
    def warehouse(self) -> Warehouse:
        """A catalog brought up to date with the first and then the second delivery."""
        root = scratch_path(self.spark, "warehouse")
        # The second delivery touches every year, so the years have buckets, as many as the sales fill.
        lines = footers(self.spark.read.parquet(f"{self.folder}/lineitem.parquet")).count()
        buckets = max(LEAST_BUCKETS, -(-lines // BUCKET_ROWS))
        warehouse = Warehouse(self.spark, "sample_" + root.rsplit("-", 1)[1], root, buckets, parts="year")
        with shuffle_partitions(self.spark, buckets), small_scans(self.spark):
            for part, run_ts in ((1, FIRST_RUN), (2, SECOND_RUN)):
                deliveries = {entity: self.delivery(entity, part) for entity in ENTITIES}
                refresh(warehouse, deliveries, run_ts, {"sales": sales_order()})
        return warehouse

    def _one_per_key(self, rows: DataFrame, entity: str) -> DataFrame:
        order = self.order(entity)
        return dedupe_latest(rows, ENTITY_KEY[entity], order, null_keys="drop") if order else rows

    def _columns(self, entity: str) -> list[str]:
        spec = BRONZE[entity]
        return [c for c in spec.columns if c != spec.stamp]

    @cached_property
    def _buckets(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _in_buckets(self, sales: DataFrame, name: str) -> DataFrame:
        """Sales stored in buckets of their key, so that merging them moves none of them again."""
        table = f"{name}_{uuid.uuid4().hex}"
        writer = sales.write.format("parquet").option("path", scratch_path(self.spark, name)).option("compression", "zstd")
        with small_scans(self.spark):
            writer.bucketBy(self._buckets, "TransactionID").sortBy("TransactionID").saveAsTable(table)
        return self.spark.table(table)

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def sample_run(spark: SparkSession, folder: str) -> SampleRun:
    return _sample_run(spark.sparkContext.applicationId, spark, folder)


@cache
def _sample_run(application: str, spark: SparkSession, folder: str) -> SampleRun:
    return SampleRun(spark, folder)
