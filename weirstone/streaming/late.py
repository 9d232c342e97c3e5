"""Late rows of a stream: a side output, and windows that fire again.

Spark's stateful operators drop late rows silently, so the split happens before
them, in `foreachBatch`. The watermark of a micro-batch is the largest event time
of the earlier ones minus the delay; each batch leaves its largest event time in
the shared folder, so a repeated or restarted batch sees the same watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weirstone.functions.timecols import epoch_micros, floor_to, from_micros, micros_of
from weirstone.operators.firings import LATE, ON_TIME, START, fold_late, labelled, window_totals
from weirstone.operators.late import classify_lateness
from weirstone.operators.running import Fold
from weirstone.operators.windows import Measure
from weirstone.sinks.keyed import BATCH
from weirstone.streaming.state import Versions

Sink = Callable[[DataFrame, int], None]


def _earlier(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    return spark.read.schema(f"seen long, {BATCH} long").parquet(path).where(F.col(BATCH) < batch_id)


class LateSplit:
    """`foreachBatch` function: rows still accepted go to `main`, the rest to `side`."""

    def __init__(
        self, path: str, *, ts: str, size: str, slide: str | None = None, delay: str, lateness: str = "0 seconds",
        main: Sink, side: Sink,
    ) -> None:
        self.path, self.ts, self.main, self.side = path, ts, main, side
        self.size, self.slide = micros_of(size), micros_of(slide or size)
        self.delay, self.lateness = micros_of(delay), micros_of(lateness)

    def watermark(self, spark: SparkSession, batch_id: int) -> int | None:
        if batch_id == 0:
            return None
        seen = _earlier(spark, self.path, batch_id).agg(F.max("seen")).first()[0]
        return None if seen is None else seen - self.delay

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        us = epoch_micros(self.ts)
        batch.persist()
        try:
            wm = self.watermark(batch.sparkSession, batch_id)
            end = floor_to(us, self.slide) + self.size
            too_late = F.lit(False) if wm is None else end + self.lateness <= F.lit(wm)
            self.main(batch.where(~too_late), batch_id)
            self.side(batch.where(too_late), batch_id)
            mark = batch.agg(F.max(us).alias("seen"))
            mark.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")
        finally:
            batch.unpersist()


class RefiringWindows:
    """Tumbling windows kept as partial aggregates per micro-batch.

    A late row that is still accepted changes its window at the next `read`: the
    window fires again with the merged value.
    """

    def __init__(self, path: str, *, keys: Sequence[str], ts: str, size: str, measures: dict[str, Measure]) -> None:
        self.path, self.keys, self.ts = path, list(keys), ts
        self.size, self.measures = micros_of(size), measures

    def write(self, batch: DataFrame, batch_id: int) -> None:
        start = floor_to(epoch_micros(self.ts), self.size).alias("_start")
        parts = batch.groupBy(*self.keys, start).agg(*[m.partial.alias(n) for n, m in self.measures.items()])
        parts.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")

    def read(self, spark: SparkSession, empty: DataFrame | None = None) -> DataFrame:
        """All windows; `empty`, a frame like the input, gives the columns where nothing was written yet."""
        if empty is not None:
            self.write(empty.limit(0), -1)
        parts = spark.read.option("basePath", self.path).parquet(self.path)
        whole = parts.groupBy(*self.keys, "_start").agg(*[m.merge(n).alias(n) for n, m in self.measures.items()])
        return whole.select(
            *self.keys,
            from_micros(F.col("_start")).alias("window_start"),
            from_micros(F.col("_start") + self.size).alias("window_end"),
            *self.measures,
        )


class LateFirings:
    """`foreachBatch` function: every firing of tumbling windows, late rows included.

    The watermark follows single rows in their order of arrival, as `late_firings` has it, so
    the firings do not depend on how the rows are cut into micro-batches. Kept between
    them are the largest event time and the totals of the windows that may still change, below
    `path`, which a query that goes on from a checkpoint has to name again. `flush` fires what is left at the end of a bounded input.
    """

    def __init__(
        self, spark: SparkSession, sample: DataFrame, *, keys: Sequence[str], ts: str, order: Sequence[str], size: str, delay: str, lateness: str,
        folds: dict[str, Fold], write: Sink, path: str | None = None,
    ) -> None:
        self.keys, self.ts, self.order, self.folds, self.write = list(keys), ts, list(order), folds, write
        self.size, self.delay, self.lateness = micros_of(size), micros_of(delay), micros_of(lateness)
        empty = window_totals(spark.createDataFrame([], sample.schema).withColumn(START, F.lit(0).cast("long")), keys=self.keys, order=order, folds=folds)
        self.held = Versions(spark, empty.withColumns({LATE: F.lit(0).cast("long"), "_fired": F.lit(False)}).schema, path and f"{path}/held")
        self.seen = Versions(spark, "seen long", path and f"{path}/seen")

    def _merged(self, parts: DataFrame) -> DataFrame:
        """Totals of the same window brought together; rows in time come before the late ones."""
        by = [*self.keys, START]
        ordered = Window.partitionBy(*by).orderBy("_part")
        last = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("_part")))
        upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        folded = parts.select(
            *by, *[F.sum(c).over(upto).alias(c) for c in (ON_TIME, LATE)], F.max("_fired").over(upto).alias("_fired"),
            *[f.carry(F.col(n), upto).alias(n) for n, f in self.folds.items()], last.alias("_last"),
        )
        return folded.where("_last = 1").drop("_last")

    def _first(self, totals: DataFrame) -> DataFrame:
        return totals.select(*self.keys, START, F.lit(1).cast("long").alias("firing"), *[f.merge(F.lit(None), F.col(n)).alias(n) for n, f in self.folds.items()])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self.held.before(spark, batch_id)
        seen = self.seen.before(spark, batch_id).first()
        seen = None if seen is None else seen["seen"]
        judged = classify_lateness(batch, ts=self.ts, order=self.order, size=self.size, delay=self.delay, lateness=self.lateness, seen_before=seen)
        placed = judged.where("lateness <> 'too_late'").withColumn(START, floor_to(epoch_micros(self.ts), self.size)).persist()
        try:
            latest = batch.agg(F.max(epoch_micros(self.ts)).alias("seen")).first()["seen"]
            latest = max((x for x in (seen, latest) if x is not None), default=None)
            self.seen.write(spark.createDataFrame([(latest,)], "seen long"), batch_id)
            none = {LATE: F.lit(0).cast("long"), "_fired": F.lit(False)}
            by, order = [*self.keys, START], self.order
            fresh = window_totals(placed.where("lateness = 'on_time'"), keys=self.keys, order=order, folds=self.folds).withColumns(none)
            on_time = self._merged(before.withColumn("_part", F.lit(0)).unionByName(fresh.withColumn("_part", F.lit(1)))).persist()
            late = placed.where("lateness = 'late'")
            passed = F.lit(False) if latest is None else F.col(START) + self.size <= F.lit(latest - self.delay)
            firing = on_time.where(passed & ~F.col("_fired") & (F.col(ON_TIME) > 0))
            again = fold_late(late, on_time, keys=self.keys, order=order, folds=self.folds)
            out = self._first(firing)
            self.write(labelled(out.unionByName(again.select(*out.columns)), self.keys, self.size, list(self.folds)), batch_id)
            added = window_totals(late, keys=self.keys, order=order, folds=self.folds)
            added = added.withColumns({LATE: F.col(ON_TIME), ON_TIME: F.lit(0).cast("long"), "_fired": F.lit(True)})
            parts = on_time.withColumns({"_fired": F.col("_fired") | passed, "_part": F.lit(0)}).unionByName(added.withColumn("_part", F.lit(1)))
            gone = F.lit(False) if latest is None else F.col(START) + self.size + self.lateness <= F.lit(latest - self.delay)
            self.held.write(self._merged(parts).where(~gone).select(*by, ON_TIME, LATE, "_fired", *self.folds), batch_id)
            self.batch_id = batch_id
            on_time.unpersist()
        finally:
            placed.unpersist()

    def flush(self, spark: SparkSession) -> None:
        """Fire the windows that the watermark has not reached, as one more batch."""
        held = self.held.before(spark, self.batch_id + 1).where(~F.col("_fired") & (F.col(ON_TIME) > 0))
        self.write(labelled(self._first(held), self.keys, self.size, list(self.folds)), self.batch_id + 1)
