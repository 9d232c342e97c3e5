"""JSON and CSV values in string columns (message payloads)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType


def decode_json(df: DataFrame, value: str, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, F.from_json(F.col(value), schema).alias("_r")).select(*keep, "_r.*")


def decode_csv(df: DataFrame, value: str, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return df.select(*keep, F.from_csv(F.col(value), ddl).alias("_r")).select(*keep, "_r.*")


def encode_json(columns: Sequence[str | Column]) -> Column:
    return F.to_json(F.struct(*columns))


def encode_csv(columns: Sequence[str | Column]) -> Column:
    return F.to_csv(F.struct(*columns))
