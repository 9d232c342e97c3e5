"""Text and delimited files, bounded or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from weirstone.schemas import TABLES


def _reader(spark: SparkSession, stream: bool, files_per_trigger: int | None):
    if not stream:
        return spark.read
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader


def text_lines(
    spark: SparkSession, path: str, *, stream: bool = False, files_per_trigger: int | None = None
) -> DataFrame:
    """Every line of a file or folder as column `value`."""
    return _reader(spark, stream, files_per_trigger).option("lineSep", "\n").text(path)


def delimited(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    sep: str = ",",
    malformed: str = "FAILFAST",
    stream: bool = False,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Delimited lines to typed rows; blank lines are dropped.

    A malformed line fails the job unless `malformed` is DROPMALFORMED or PERMISSIVE.
    Lines are parsed whole: the CSV reader converts only the fields a query uses,
    so it would miss a bad value in another one.
    """
    lines = text_lines(spark, path, stream=stream, files_per_trigger=files_per_trigger)
    lines = lines.where(F.trim("value") != "")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"sep": sep, "mode": "FAILFAST"}
    if malformed != "FAILFAST":
        ddl += ", _bad string"
        options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    rows = lines.select(F.from_csv("value", ddl, options).alias("r")).select("r.*")
    if malformed == "DROPMALFORMED":
        rows = rows.where(F.col("_bad").isNull())
    return rows.select(*schema.fieldNames())


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A warehouse table of the given folder, schema declared."""
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def table_stream(
    spark: SparkSession, folder: str, name: str, *, files_per_trigger: int | None = None
) -> DataFrame:
    """The same table as a stream of its files.

    The path is a pattern, since a stream source takes a single file only that way.
    """
    reader = _reader(spark, True, files_per_trigger)
    return reader.schema(TABLES[name]).parquet(f"{folder}/{name}[.]parquet")
