"""A bounded table as a stream in the order of its arrival column.

A stream over a table's files takes them in the order of their names or times, which
says nothing about when the rows arrived: with a watermark, rows of a file that comes
late are dropped. Here the rows are dealt into slices of about `slice_rows` rows by ranges of
the arrival column, each micro-batch is one slice, and the outcome is the same however the
table is laid out. One range shuffle writes all slices to the shared folder, a folder each, so
the table is not read again however many slices it has; `advance` brings the next one into the
folder that the stream watches. A table of one slice is read where it lies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from weirstone.session import scratch
from weirstone.sources.files import table, table_stream

# Rows of a micro-batch: one task may get them all, if they have one key.
SLICE_ROWS = 1 << 20
# Slice numbers that the driver takes from the manifest at a time.
LISTED = 1000
NO_MORE = object()


class Feed:
    """`stream` is the table as a stream; `advance` makes its next slice readable, False after the last.

    `ended` is True once the last slice is readable.

    `shape` adds columns to the table before it is cut. With `end`, a time column, one more
    slice follows: a row long after all others, with `marks` in its other columns. It moves the
    watermark on, so that the last windows and timers fire; the query tells it by its marks.
    `stamp` names a column for the time at which a slice came in: it is written with the slice,
    so a micro-batch that is repeated sees the same time.
    """

    def __init__(
        self, spark: SparkSession, folder: str, name: str, order: str, slice_rows: int | None = None, end: str | None = None,
        marks: dict | None = None, shape: Callable[[DataFrame], DataFrame] | None = None, stamp: str | None = None,
    ) -> None:
        shape = shape or (lambda df: df)
        self.spark, self.order, self.done, self.stamp = spark, order, 0, stamp
        self.parts, self.ended = self._parts(), False
        rows = shape(table(spark, folder, name))
        self.schema, self.last = rows.schema, None
        if end is not None:
            values = {**dict.fromkeys(rows.columns, F.lit(None)), **{k: F.lit(v) for k, v in (marks or {}).items()}}
            values[end] = F.coalesce(F.max(end), F.lit("2000-01-01").cast("timestamp_ntz")) + F.expr("INTERVAL 4000 DAYS")
            kinds = {f.name: f.dataType for f in rows.schema}
            self.last = rows.agg(values[end].alias(end)).select(*[(F.col(c) if c == end else values[c]).cast(kinds[c]).alias(c) for c in rows.columns])
        count = max(1, -(-table(spark, folder, name).count() // (slice_rows or SLICE_ROWS)))
        if count == 1 and end is None and stamp is None:
            self.path, self.slices = None, iter([None])
            self.stream = shape(table_stream(spark, folder, name))
            return
        self.path = scratch(spark, "feed")
        shown = StructType([*self.schema.fields, *([StructField(stamp, TimestampType())] if stamp else [])])
        self.stream = spark.readStream.schema(shown).parquet(f"{self.path}/shown/slice-*")
        if count == 1:
            rows.write.parquet(f"{self.path}/cut/_slice=0")
            self.slices = iter([0])
        else:
            dealt = rows.repartitionByRange(count, order).withColumn("_slice", F.spark_partition_id())
            dealt.write.partitionBy("_slice").parquet(f"{self.path}/cut")
            self.slices = self._listed()

    def _listed(self) -> Iterator[int]:
        """Numbers of the slices that hold rows, in order, some at a time."""
        manifest = f"{self.path}/manifest"
        self.spark.read.parquet(f"{self.path}/cut").select("_slice").distinct().write.parquet(manifest)
        numbers, last = self.spark.read.schema("_slice int").parquet(manifest), -1
        while some := [r[0] for r in numbers.where(F.col("_slice") > last).orderBy("_slice").limit(LISTED).collect()]:
            yield from some
            last = some[-1]

    def _show(self, rows: DataFrame) -> None:
        if self.stamp:
            rows = rows.withColumn(self.stamp, F.current_timestamp())
        rows.write.mode("overwrite").parquet(f"{self.path}/shown/slice-{self.done:09d}")

    def _parts(self) -> Iterator[DataFrame | None]:
        """What each slice shows; None for a table read where it lies."""
        for number in self.slices:
            yield None if number is None else self.spark.read.schema(self.schema).parquet(f"{self.path}/cut/_slice={number}")
        if self.last is not None:
            yield self.last

    def advance(self) -> bool:
        if self.done == 0:
            self.coming = next(self.parts, NO_MORE)
        if self.coming is NO_MORE:
            return False
        part, self.coming = self.coming, next(self.parts, NO_MORE)
        if part is not None:
            self._show(part)
        self.done += 1
        self.ended = self.coming is NO_MORE
        return True
