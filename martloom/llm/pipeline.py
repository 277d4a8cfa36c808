"""A training corpus made from raw documents: five stages, each over all that the one before it kept.

    run(spark, "/data/sf")      # stages in turn, each written as Parquet and read again
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import decontaminate, mixing, near, private, quality
from martloom.llm.sample import learnable
from martloom.llm.scratch import free, stored

#: Documents with a lower quality score go.
LEAST_QUALITY = 0.3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject; it learns from the labels of four fifths of them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs.filter(learnable(5, 0)), labels.filter(learnable(5, 0)))
    (score,) = free(docs, "score")
    return quality.scored(docs, model, score).filter(F.col(score) >= LEAST_QUALITY).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with surrogates for personal data."""
    changed = private.pseudonymised(docs)
    length = F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return changed.withColumn("n_chars", length).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, and how often (copies)."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("near-duplicate removal", drop_copies),
    ("benchmark decontamination", drop_contaminated),
    ("surrogates for personal data", replace_private),
    ("source mixing", mix_sources),
]

#: SQL cannot express the stages; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
