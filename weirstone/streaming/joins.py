"""A left join over micro-batches as a changelog, with event-time retention."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirstone.functions.timecols import epoch_micros, micros_of
from weirstone.operators.joins import changelog_rows, first_partners, interval_join
from weirstone.streaming.runner import RowsDropped
from weirstone.streaming.state import Versions


class LeftJoinLog:
    """`foreachBatch` function over rows of both inputs: the changelog of `left_join_changelog`.

    `split` gives the left and the right rows of a micro-batch. Kept between micro-batches
    are the rows of the last `keep` of event time, and of a left row whether it still stands
    padded; a batch joins its own rows with those in time buckets, so no key is loaded whole.
    Rows may come `delay` behind the latest event time of earlier batches; older ones raise
    RowsDropped, as what they should meet may be gone. State lies below `path`, which a query
    that goes on from a checkpoint has to name again.
    """

    def __init__(
        self, spark: SparkSession, split: Callable[[DataFrame], tuple[DataFrame, DataFrame]], sample: DataFrame, *, keys: Sequence[str], left_id: str,
        right_id: str, left_ts: str, right_ts: str, keep: str, delay: str, write: Callable[[DataFrame, int], None],
        path: str | None = None,
    ) -> None:
        self.split, self.keys, self.keep, self.write = split, list(keys), keep, write
        self.left, self.right = (left_id, left_ts), (right_id, right_ts)
        self.keep_us, self.delay_us = micros_of(keep), micros_of(delay)
        left, right = split(spark.createDataFrame([], sample.schema))
        self.lefts = Versions(spark, left.select(*self.keys, *self.left).withColumn("_padded", F.lit(True)).schema, path and f"{path}/left")
        self.rights = Versions(spark, right.select(*self.keys, *self.right).schema, path and f"{path}/right")
        self.seen = Versions(spark, "seen long", path and f"{path}/seen")

    def _pairs(self, left: DataFrame, right: DataFrame) -> DataFrame:
        return interval_join(
            left.select(*self.keys, *self.left), right, keys=self.keys, left_ts=self.left[1], right_ts=self.right[1], lower=f"-{self.keep}", upper=self.keep
        )

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, (left_id, left_ts), (right_id, right_ts) = batch.sparkSession, self.left, self.right
        batch.persist()
        try:
            new_left, new_right = self.split(batch)
            new_left, new_right = new_left.select(*self.keys, *self.left), new_right.select(*self.keys, *self.right)
            old_left, old_right = self.lefts.before(spark, batch_id), self.rights.before(spark, batch_id)
            known = self.seen.before(spark, batch_id).first()
            known = None if known is None else known["seen"]
            times = new_left.select(epoch_micros(left_ts).alias("us")).union(new_right.select(epoch_micros(right_ts).alias("us")))
            oldest, latest = times.agg(F.min("us"), F.max("us")).first()
            if known is not None and oldest is not None and oldest < known - self.delay_us:
                raise RowsDropped(f"a row lies more than {self.delay_us} microseconds behind: raise the delay")
            latest = max((x for x in (known, latest) if x is not None), default=None)
            self.seen.write(spark.createDataFrame([(latest,)], "seen long"), batch_id)
            met = self._pairs(new_left, old_right.unionByName(new_right))
            met_again = self._pairs(old_left, new_right)
            fresh = first_partners(new_left, met, left_id, right_id)
            fresh = fresh.withColumn("_own", F.col("_first").isNull() | (F.col("_first") > F.col(left_id)))
            standing = first_partners(old_left, met_again, left_id, right_id).withColumn("_own", F.lit(False))
            padded = fresh.where("_own").unionByName(standing.where("_padded").drop("_padded"))
            self.write(changelog_rows(self.keys, met.unionByName(met_again), padded, left_id, right_id), batch_id)
            after = fresh.select(*self.keys, *self.left, F.col("_first").isNull().alias("_padded")).unionByName(
                standing.select(*self.keys, *self.left, (F.col("_padded") & F.col("_first").isNull()).alias("_padded"))
            )
            rights = old_right.unionByName(new_right)
            if latest is not None:
                least = F.lit(latest - self.delay_us - self.keep_us)
                after, rights = after.where(epoch_micros(left_ts) >= least), rights.where(epoch_micros(right_ts) >= least)
            self.lefts.write(after, batch_id)
            self.rights.write(rights, batch_id)
        finally:
            batch.unpersist()
