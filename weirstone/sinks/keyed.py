"""Keyed upsert and document sinks for `foreachBatch`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from weirstone.operators.rolling import last_per_key
from weirstone.sources.codecs import encode_json

BATCH = "batch_id"


class UpsertLog:
    """A keyed table kept as one folder of last-per-key rows per micro-batch.

    Writing a batch again replaces its folder, so a retried batch changes nothing.
    Reading takes the newest row per key; `compact` folds the log into one folder.
    """

    def __init__(self, path: str, keys: Sequence[str], order: Sequence[str] = ()) -> None:
        self.path, self.keys, self.order = path, list(keys), list(order)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        rows = last_per_key(batch, keys=self.keys, order=self.order) if self.order else batch
        rows.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")

    def read(self, spark: SparkSession, schema: StructType | None = None) -> DataFrame:
        """Newest row per key; with a schema, no rows where nothing was written yet."""
        if schema is not None:
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.path}/{BATCH}=-1")
        log = spark.read.option("basePath", self.path).parquet(self.path)
        return last_per_key(log, keys=self.keys, order=[BATCH, *self.order]).drop(BATCH)

    def compact(self, spark: SparkSession, path: str, upto: int) -> "UpsertLog":
        """Copy the table as of batch `upto` to a new folder as its single entry."""
        target = UpsertLog(path, self.keys, self.order)
        self.read(spark).write.mode("overwrite").parquet(f"{path}/{BATCH}={upto}")
        return target


def documents(df: DataFrame, fields: Sequence[str], id_columns: Sequence[str] = (), sep: str = "-") -> DataFrame:
    """Rows as documents: JSON `_source`, and `_id` from the key columns when given."""
    source = encode_json(fields).alias("_source")
    if not id_columns:
        return df.select(source)
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in id_columns]).alias("_id"), source)
