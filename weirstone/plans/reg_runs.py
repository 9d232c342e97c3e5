"""Registered queries: how streams run. One source with several outputs, recovery, ingest time."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.operators.running import previous, running
from weirstone.operators.windows import window_aggregate
from weirstone.plans.inputs import SENSOR, sensor_stream, shape_sensor
from weirstone.plans.reg_grouped import WORDCOUNT_SQL
from weirstone.plans.registry import query
from weirstone.session import scratch
from weirstone.streaming.feed import Feed
from weirstone.streaming.runner import drain, latest_rows
from weirstone.streaming.state import Versions

JUMP = 5000


class SensorFanout:
    """`foreachBatch` function: counts per sensor and jump alerts per user from one pass over a micro-batch.

    The micro-batch is read once and kept for both outputs. Between micro-batches are kept
    the counts, and the last value of each user; a repeated one starts from the same state.
    """

    def __init__(self, spark, target: str) -> None:
        self.target = target
        self.counts, self.last = Versions(spark, "id string, ct long"), Versions(spark, "user_id long, seq long, vc long")

    def __call__(self, batch, batch_id: int) -> None:
        spark, rows = batch.sparkSession, batch.select("id", "user_id", "seq", "vc").persist()
        try:
            fresh = rows.groupBy("id").agg(F.count(F.lit(1)).alias("ct"))
            self.counts.write(self.counts.before(spark, batch_id).union(fresh).groupBy("id").agg(F.sum("ct").alias("ct")), batch_id)
            held = self.last.before(spark, batch_id)
            seen = rows.select("user_id", "seq", "vc").withColumn("_own", F.lit(True)).union(held.withColumn("_own", F.lit(False)))
            steps = running(seen, keys=["user_id"], order=["seq"], folds={"prev": previous(F.col("vc"))})
            jumps = steps.where(F.col("_own") & (F.abs(F.col("vc") - F.col("prev")) > JUMP)).select("user_id", "seq", "vc")
            jumps.write.mode("overwrite").parquet(f"{self.target}/batch_id={batch_id}")
            self.last.write(seen.groupBy("user_id").agg(F.max_by(F.struct("seq", "vc"), "seq").alias("r")).select("user_id", "r.*"), batch_id)
            self.done = batch_id
        finally:
            rows.unpersist()

    def read(self, spark):
        """(branch, name, seq, value) of both outputs."""
        counts = self.counts.before(spark, self.done + 1)
        alerts = spark.read.schema("user_id long, seq long, vc long").parquet(f"{self.target}/batch_id=*")
        return counts.select(F.lit("count").alias("branch"), F.col("id").alias("name"), F.lit(None).cast("long").alias("seq"), F.col("ct").alias("value")).union(
            alerts.select(F.lit("alert"), F.col("user_id").cast("string"), "seq", "vc")
        )


@query(
    "sensor_fanout",
    f"""WITH {SENSOR}, p AS (SELECT user_id, seq, vc, lag(vc) OVER (PARTITION BY user_id ORDER BY seq) AS prev FROM sensor)
    SELECT 'count' AS branch, id AS name, CAST(NULL AS BIGINT) AS seq, count(*) AS value FROM sensor GROUP BY id
    UNION ALL SELECT 'alert', CAST(user_id AS VARCHAR), seq, vc FROM p WHERE abs(vc - prev) > {JUMP}""",
)
def sensor_fanout(spark, folder):
    rows, feed = sensor_stream(spark, folder)
    job = SensorFanout(spark, scratch(spark, "alerts"))
    drain(rows, job, mode="append", feed=feed)
    return job.read(spark)


class CountedOnce:
    """`foreachBatch` function: word counts that a failure between its two writes does not count twice.

    A micro-batch replaces its own folder of counts and its own entry in the log of rows,
    which says how far the input is counted; the state keeps the rows of all batches.
    """

    def __init__(self, spark, path: str) -> None:
        self.path, self.rows, self.tries = path, Versions(spark, "n long"), []

    def between(self, batch_id: int) -> None:
        """Called between the two writes; tests and the registered query fail here once."""

    def __call__(self, batch, batch_id: int) -> None:
        spark = batch.sparkSession
        self.tries.append(batch_id)
        words = batch.select(F.explode(F.split("text", "[ \n]")).alias("word")).where("word <> ''")
        words.groupBy("word").agg(F.count(F.lit(1)).alias("ct")).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        self.between(batch_id)
        counted = self.rows.before(spark, batch_id).union(batch.agg(F.count(F.lit(1)).alias("n"))).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        self.rows.write(counted, batch_id)

    def read(self, spark):
        return spark.read.schema("word string, ct long").parquet(f"{self.path}/batch_id=*").groupBy("word").agg(F.sum("ct").alias("ct"))


class FailsOnce(CountedOnce):
    """The first micro-batch fails between its writes when it is tried first."""

    failed = False

    def between(self, batch_id: int) -> None:
        if not self.failed:
            self.failed = True
            raise RuntimeError(f"made to fail in micro-batch {batch_id}")


@query("wordcount_recovered", WORDCOUNT_SQL)
def wordcount_recovered(spark, folder):
    """The word count with a sink that fails once: the query goes on from its checkpoint and repeats the batch."""
    feed = Feed(spark, folder, "documents", "doc_id")
    job = FailsOnce(spark, scratch(spark, "counts"))
    drain(feed.stream, job, mode="append", feed=feed, restarts=1)
    return job.read(spark)


@query("proc_windows_total", f"WITH {SENSOR} SELECT id, count(*) AS tumbled, 2 * count(*) AS slid FROM sensor GROUP BY id")
def proc_windows_total(spark, folder):
    """Tumbling and sliding windows on the time at which rows came in; what all windows of a key hold together.

    The times differ from run to run, the rows in all windows do not: each is in one
    tumbling window and in two that slide by half their size.
    """
    totals = []
    for name, slide in (("tumbled", None), ("slid", "5 seconds")):
        feed = Feed(spark, folder, "events", "event_id", stamp="came")
        rows = shape_sensor(feed.stream, "came").withWatermark("came", "1 minute")
        found = window_aggregate(rows, keys=["id"], ts="came", size="10 seconds", slide=slide, aggs={"ct": F.count(F.lit(1))})
        windows = latest_rows(found, keys=["id", "window_start", "window_end"], feed=feed)
        totals.append(windows.groupBy("id").agg(F.sum("ct").alias(name)))
    return totals[0].join(totals[1], "id")
