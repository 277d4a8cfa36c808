"""Header-row CSV files, and the loader for small test inputs."""

from __future__ import annotations

from pathlib import PurePath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from martloom.schemas import BRONZE, ENTITIES


BAD_LINES = ("keep", "reject", "fail")
# Working columns: a line that does not fit the header, and the file it is in.
_LINE, _FILE = "_line", "_file"


def read_entity_csv(spark: SparkSession, path: str, entity: str, bad_lines: str = "keep") -> DataFrame:
    """One delivery of an entity, columns taken by header name and cast to their declared type.

    No inference: it would read the file twice and turn a key such as ``001`` into a number.
    ``path`` may be a folder whose files all have the same header; one with other names or another
    order fails the job.

    ``bad_lines``: ``keep`` takes values missing at the end of a line as NULL and ignores values beyond the
    header; a value that does not fit its type fails the job, a fraction in a column of whole numbers too.
    ``fail`` fails for lines with too few or too many values as well. ``reject`` leaves all such lines out;
    ``rejected_lines`` lists them.
    """
    if bad_lines not in BAD_LINES:
        raise ValueError(f"bad_lines must be one of {', '.join(BAD_LINES)}, not {bad_lines!r}")
    lines, declared = _lines(spark, path), _declared(entity)
    if bad_lines == "reject":
        lines = lines.filter(_fault(lines, declared).isNull())
    if bad_lines == "fail":
        told = F.raise_error(F.concat_ws(": ", F.lit("line does not fit the header"), _FILE, _LINE)).cast("boolean")
        lines = lines.filter(F.when(F.col(_LINE).isNotNull(), told).otherwise(True))
    return lines.select(*(_typed(f) for f in declared))


def rejected_lines(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """file, reason and line of every line that ``bad_lines="reject"`` leaves out."""
    lines = _lines(spark, path)
    whole = F.to_csv(F.struct(*(c for c in lines.columns if c not in (_LINE, _FILE))))
    told = lines.select(F.col(_FILE).alias("file"), _fault(lines, _declared(entity)).alias("reason"), F.coalesce(_LINE, whole).alias("line"))
    return told.filter("reason IS NOT NULL")


def _declared(entity: str) -> list[StructField]:
    spec = BRONZE[entity]
    return [f for f in spec.schema.fields if f.name != spec.stamp]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Values of every line as text, by header name, and the line itself where their number is another one."""
    # Every file's own header is held against the names, which come from one of them.
    names = spark.read.csv(path, header=True, enforceSchema=False).columns
    schema = StructType([StructField(name, StringType()) for name in (*names, _LINE)])
    raw = spark.read.schema(schema).csv(path, header=True, enforceSchema=False, columnNameOfCorruptRecord=_LINE)
    return raw.withColumn(_FILE, F.col("_metadata.file_path"))


def _fault(lines: DataFrame, declared: list[StructField]) -> Column:
    """Why a line is bad, NULL for a good one."""
    # Commas outside quotes.
    values = F.size(F.split(_LINE, r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1))
    named = len(lines.columns) - 2
    fault = F.when(F.col(_LINE).isNotNull() & (values < named), "too few values")
    fault = fault.when(F.col(_LINE).isNotNull() & (values > named), "too many values").when(F.col(_LINE).isNotNull(), "unreadable")
    for field in declared:
        if not isinstance(field.dataType, StringType):
            value = F.col(field.name)
            fits = value.try_cast(field.dataType).isNotNull()
            if isinstance(field.dataType, IntegerType):
                number = value.try_cast("double")
                fits = F.coalesce(number == F.floor(number), F.lit(False)) & number.try_cast(field.dataType).isNotNull()
            fault = fault.when(value.isNotNull() & ~fits, f"{field.name} is no {field.dataType.simpleString()}")
    return fault


def read_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four entities of a delivery folder with one ``<entity>.csv`` each."""
    return {entity: read_entity_csv(spark, f"{folder}/{entity}.csv", entity) for entity in ENTITIES}


def load_fixture(spark: SparkSession, path: str) -> DataFrame:
    """A small JSON array or CSV file as a DataFrame; CSV values stay text, empty ones ``''``."""
    suffix = PurePath(path).suffix.lower()
    if suffix == ".json":
        return spark.read.json(path, multiLine=True)
    if suffix == ".csv":
        return spark.read.csv(path, header=True).na.fill("")
    raise ValueError(f"fixture must be .json or .csv: {path}")


def _typed(field: StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, StringType):
        return value
    if isinstance(field.dataType, IntegerType):
        # "3.0" is a whole number too.
        number = value.cast("double")
        message = F.concat(F.lit(f"{field.name} is no whole number: "), value)
        value = F.when(number != F.floor(number), F.raise_error(message).cast("double")).otherwise(number)
    return value.cast(field.dataType).alias(field.name)
