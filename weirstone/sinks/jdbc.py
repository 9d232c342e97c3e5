"""JDBC sinks: append, and upsert by a staging table and one MERGE."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from weirstone.operators.rolling import last_per_key


def append(url: str, table: str, properties: dict[str, str], batch_rows: int = 10_000) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function appending each batch.

    At least once: a batch that is repeated after a failure is appended again. Use
    `upsert` where that matters.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.option("batchsize", batch_rows).jdbc(url, table, mode="append", properties=properties)

    return write


def merge_sql(table: str, stage: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """Standard MERGE that updates the non-key columns or inserts the row."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    rest = [c for c in columns if c not in keys]
    update = f" WHEN MATCHED THEN UPDATE SET {', '.join(f'{c} = s.{c}' for c in rest)}" if rest else ""
    return (
        f"MERGE INTO {table} t USING {stage} s ON {on}{update}"
        f" WHEN NOT MATCHED THEN INSERT ({', '.join(columns)})"
        f" VALUES ({', '.join(f's.{c}' for c in columns)})"
    )


def upsert_rows(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """What an upsert of the batch stores: its last row per key."""
    return last_per_key(batch, keys=keys, order=order)


def upsert(
    url: str,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    properties: dict[str, str],
    columns: Sequence[str],
) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function: executors load the staging table, the driver merges once.

    Repeating a batch stages and merges the same rows again, which changes nothing.
    Each writer and batch has a staging table of its own, which goes after the merge.
    """
    writer = uuid.uuid4().hex[:12]

    def write(batch: DataFrame, batch_id: int) -> None:
        stage = f"{table}_stage_{writer}_{batch_id}"
        rows = upsert_rows(batch, keys, order).select(*columns)
        rows.write.jdbc(url, stage, mode="overwrite", properties=properties)
        jvm = batch.sparkSession._jvm
        connection = jvm.java.sql.DriverManager.getConnection(
            url, properties.get("user", ""), properties.get("password", "")
        )
        try:
            statement = connection.createStatement()
            statement.executeUpdate(merge_sql(table, stage, keys, columns))
            statement.executeUpdate(f"DROP TABLE {stage}")
            statement.close()
        finally:
            connection.close()

    return write
