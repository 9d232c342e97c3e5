"""Declared tables, views and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def declare_csv(spark: SparkSession, name: str, path: str, schema: StructType, sep: str = ",") -> None:
    """Register a CSV path under a name usable in SQL (DDL).

    Spark's reader checks the fields a query uses; `files.delimited` checks all.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW `{name}` ({columns}) USING csv "
        f"OPTIONS (path '{path}', sep '{sep}', mode 'FAILFAST')"
    )


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a bounded or streaming frame as a view; returns the frame."""
    df.createOrReplaceTempView(name)
    return df


def save_to_catalog(df: DataFrame, name: str, path: str, mode: str = "overwrite") -> None:
    """Store a frame as a catalog table at an explicit (shared) path."""
    df.write.mode(mode).format("parquet").option("path", path).saveAsTable(name)


def scan_catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
