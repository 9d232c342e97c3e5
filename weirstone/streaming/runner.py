"""Run a streaming plan over what is available and hand back its rows as a table.

Results go through a folder below the shared root, never through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from weirstone.session import scratch
from weirstone.sinks.keyed import UpsertLog
from weirstone.streaming.feed import Feed


# Partitions that a stream's state has at least, where a shuffle has as many.
LEAST_PARTITIONS = 4


class RowsDropped(RuntimeError):
    """A watermark dropped rows that nothing put to a side output."""


def dropped(query: StreamingQuery) -> int:
    """Rows that stateful operators of a finished query dropped as late."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings, `_` for `.`, for the queries that start inside."""
    held = {k: spark.conf.get(k, None) for k in (name.replace("_", ".") for name in conf)}
    for key, value in zip(held, conf.values()):
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in held.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def state_partitions(spark: SparkSession) -> int:
    """Partitions for a stream's state: as many as tasks run at once.

    A micro-batch is one slice, however large the table. Each partition opens and commits its
    stores in every micro-batch, so one per shuffle partition of the whole table costs more
    than the rows. A stream that goes on from a checkpoint keeps the number it began with.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(spark.sparkContext.defaultParallelism, LEAST_PARTITIONS))


def run_available(writer: DataStreamWriter, feed: Feed | None = None, *, late: str = "raise", restarts: int = 0) -> None:
    """Process what is available, slice by slice with a feed, then stop.

    `late` tells what rows beyond the watermark mean: "raise" RowsDropped, or "drop".
    The writer needs a checkpoint location; a slice goes on from the one before. A query that
    fails is started again from its checkpoint up to `restarts` times in all; it repeats the
    micro-batch that failed, with the same rows. A feed's next slice also closes what the one
    before has completed; a micro-batch without rows does so after the last slice only.
    """
    while feed is None or feed.advance():
        going_on = feed is not None and not feed.ended and late == "raise"
        with settings(feed.spark, spark_sql_streaming_noDataMicroBatches_enabled="false") if going_on else nullcontext():
            while True:
                query = writer.trigger(availableNow=True).start()
                try:
                    query.awaitTermination()
                    break
                except StreamingQueryException:
                    if not restarts:
                        raise
                    restarts -= 1
        if late == "raise" and (n := dropped(query)):
            raise RowsDropped(f"{n} rows came after the watermark: raise the delay, or split late rows off first")
        if feed is None:
            return


def drain(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    *,
    mode: str,
    checkpoint: str | None = None,
    feed: Feed | None = None,
    late: str = "raise",
    restarts: int = 0,
) -> None:
    """Process everything available through `foreachBatch`, then stop."""
    writer = df.writeStream.foreachBatch(write).outputMode(mode)
    run_available(writer.option("checkpointLocation", checkpoint or scratch(df.sparkSession, "checkpoint")), feed, late=late, restarts=restarts)


def latest_rows(df: DataFrame, *, keys: Sequence[str], checkpoint: str | None = None,
                path: str | None = None, feed: Feed | None = None, late: str = "raise") -> DataFrame:
    """Final state of an update-mode aggregate: the newest row per key."""
    spark = df.sparkSession
    log = UpsertLog(path or scratch(spark, "updates"), keys)
    drain(df, log.write, mode="update", checkpoint=checkpoint, feed=feed, late=late)
    return log.read(spark, df.schema)


def appended_rows(df: DataFrame, *, mode: str = "append", checkpoint: str | None = None,
                  path: str | None = None, feed: Feed | None = None, late: str = "raise") -> DataFrame:
    """All rows an append (or per-row update) stream puts out; none if no micro-batch ran."""
    spark = df.sparkSession
    target = path or scratch(spark, "rows")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    # An empty entry, so that the folder can be read.
    spark.createDataFrame([], df.schema).write.mode("ignore").parquet(f"{target}/batch_id=-1")
    with settings(spark, spark_sql_shuffle_partitions=str(state_partitions(spark))):
        drain(df, write, mode=mode, checkpoint=checkpoint, feed=feed, late=late)
    return spark.read.schema(df.schema).option("basePath", target).parquet(f"{target}/batch_id=*").select(
        *df.columns
    )
