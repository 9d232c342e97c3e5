"""A table that each micro-batch reads as the one before left it, and writes anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from weirstone.session import scratch

# Places for versions. A repeated batch reads what its first try read, since only the next one overwrites that place.
SLOTS = 3


class Versions:
    """State of a `foreachBatch` function, as large as the state is and not as the stream is long."""

    def __init__(self, spark: SparkSession, schema: StructType | str, path: str | None = None) -> None:
        self.path = path or scratch(spark, "state")
        self.schema = spark.createDataFrame([], schema).schema

    def _slot(self, batch_id: int) -> str:
        return f"{self.path}/slot-{batch_id % SLOTS}"

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The table before a micro-batch; empty before the first."""
        if batch_id == 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self._slot(batch_id - 1))

    def write(self, table: DataFrame, batch_id: int) -> DataFrame:
        """The table after a micro-batch, as read back."""
        table.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(self._slot(batch_id))
        return table.sparkSession.read.schema(self.schema).parquet(self._slot(batch_id))
