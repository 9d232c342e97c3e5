"""Page views and unique visitors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weirstone.functions.hashing import bitmap_offset


def _hourly(df: DataFrame, ts: str, aggs: dict[str, Column]) -> DataFrame:
    grouped = df.groupBy(F.window(ts, "1 hour").alias("w")).agg(*[a.alias(n) for n, a in aggs.items()])
    return grouped.select(F.col("w.end").alias("window_end"), *aggs)


def pv_hourly(views: DataFrame, ts: str = "ts") -> DataFrame:
    return _hourly(views, ts, {"pv": F.count(F.lit(1))})


def pv_hourly_salted(views: DataFrame, ts: str = "ts", salt_on: str = "seq", salts: int = 8) -> DataFrame:
    """Counts per hour and salt, summed per hour.

    For counts Spark's partial aggregation already does this; the form is for
    aggregates without a map-side combine.
    """
    salted = views.withColumn("_salt", F.pmod(F.xxhash64(salt_on), F.lit(salts)))
    part = salted.groupBy(F.window(ts, "1 hour").alias("w"), "_salt").agg(F.count(F.lit(1)).alias("pv"))
    whole = part.groupBy("w").agg(F.sum("pv").alias("pv"))
    return whole.select(F.col("w.end").alias("window_end"), "pv")


def uv_hourly(views: DataFrame, user: str, ts: str = "ts") -> DataFrame:
    """Exact distinct users per hour; Spark first removes duplicates per (hour, user)."""
    return _hourly(views, ts, {"uv": F.count_distinct(F.col(user))})


# Bitmaps and sketches -----------------------------------------------------------------------------
#
# A bitmap of 2^30 bits is kept as its pieces of 2^15 bits that hold any; pieces of the same
# place are united by `or`, sketches by their union, so hours add up to days and micro-batches
# to hours without the visitors being read again.


def hourly_bitmaps(views: DataFrame, user: str, ts: str = "ts") -> DataFrame:
    """(hour, piece, bits): the single-hash bitmap of each hour's users; colliding users share a bit."""
    bit = bitmap_offset(F.col(user).cast("string"))
    hashed = views.select(F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour"), bit.alias("_bit")).where("_bit IS NOT NULL")
    return hashed.groupBy("hour", F.bitmap_bucket_number("_bit").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("bits"))


def united_bitmaps(bitmaps: DataFrame, unit: str = "hour") -> DataFrame:
    """Bitmaps of several sources, or of the hours of a `unit`, as one per time."""
    at = F.date_trunc(unit, "hour").cast("timestamp_ntz").alias("hour")
    return bitmaps.groupBy(at, "piece").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted_bitmaps(bitmaps: DataFrame, width: str = "1 hour") -> DataFrame:
    """(window_end, uv) of united bitmaps."""
    counts = bitmaps.groupBy("hour").agg(F.sum(F.bitmap_count("bits")).alias("uv"))
    return counts.select((F.col("hour") + F.expr(f"INTERVAL {width}")).alias("window_end"), "uv")


def uv_hourly_bitmap(views: DataFrame, user: str, ts: str = "ts") -> DataFrame:
    """Distinct single-hash offsets per hour: colliding users count once."""
    return counted_bitmaps(hourly_bitmaps(views, user, ts))


def hourly_sketches(views: DataFrame, user: str, ts: str = "ts", bits: int = 12) -> DataFrame:
    """(hour, sketch): a sketch of 2^bits cells of each hour's users; its standard error is about 0.83 / 2^(bits / 2)."""
    hour = F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")
    return views.where(F.col(user).isNotNull()).groupBy(hour).agg(F.hll_sketch_agg(user, bits).alias("sketch"))


def united_sketches(sketches: DataFrame, unit: str = "hour") -> DataFrame:
    return sketches.groupBy(F.date_trunc(unit, "hour").cast("timestamp_ntz").alias("hour")).agg(F.hll_union_agg("sketch").alias("sketch"))


def counted_sketches(sketches: DataFrame, width: str = "1 hour") -> DataFrame:
    """(window_end, uv) estimated by the sketches."""
    return sketches.select((F.col("hour") + F.expr(f"INTERVAL {width}")).alias("window_end"), F.hll_sketch_estimate("sketch").alias("uv"))


class VisitorLog:
    """Bitmaps of the hours kept as one folder per micro-batch; a repeated batch replaces its own."""

    def __init__(self, path: str, user: str, ts: str = "ts") -> None:
        self.path, self.user, self.ts = path, user, ts

    def write(self, batch: DataFrame, batch_id: int) -> None:
        hourly_bitmaps(batch, self.user, self.ts).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, spark: SparkSession, unit: str = "hour") -> DataFrame:
        """The bitmaps of all batches, united per `unit`."""
        parts = spark.read.schema("hour timestamp_ntz, piece long, bits binary").parquet(f"{self.path}/batch_id=*")
        return united_bitmaps(parts, unit)
