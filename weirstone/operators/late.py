"""Watermarks and late rows of a bounded table, by arrival order.

The watermark seen by a row is the largest event time among the rows that
arrived before it, minus the delay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from weirstone.functions.timecols import epoch_micros, floor_to, from_micros, micros_of
from weirstone.operators.running import (
    DEFAULT_BLOCKS,
    Blocks,
    running,
    running_max,
    running_max_before,
)


def watermark_trace(
    df: DataFrame, *, ts: str, order: Sequence[str], delay: str, blocks: Blocks | None = DEFAULT_BLOCKS
) -> DataFrame:
    """Watermark after each arrival: largest event time so far minus `delay`."""
    out = running(df, keys=[], order=order, folds={"_max": running_max(epoch_micros(ts))}, blocks=blocks)
    return out.withColumn("watermark", from_micros(F.col("_max") - micros_of(delay))).drop("_max")


def classify_lateness(
    df: DataFrame,
    *,
    ts: str,
    order: Sequence[str],
    size: str,
    slide: str | None = None,
    delay: str,
    lateness: str = "0 seconds",
    blocks: Blocks | None = DEFAULT_BLOCKS,
    seen_before: int | None = None,
) -> DataFrame:
    """Add `_wm` (microseconds) and `lateness`: on_time, late (refires) or too_late.

    The last window that covers the row decides, so a row of a sliding window is
    too late only when all its windows are closed for good. `seen_before` is the largest
    event time (microseconds) of rows that came before the table's.
    """
    size_us, slide_us = micros_of(size), micros_of(slide or size)
    seen = running(df, keys=[], order=order, folds={"_seen": running_max_before(epoch_micros(ts))}, blocks=blocks)
    known = F.col("_seen") if seen_before is None else F.greatest("_seen", F.lit(seen_before))
    wm = known - micros_of(delay)
    end = floor_to(epoch_micros(ts), slide_us) + size_us
    status = (
        F.when(wm.isNull() | (end > wm), "on_time")
        .when(end + micros_of(lateness) > wm, "late")
        .otherwise("too_late")
    )
    return seen.withColumn("_wm", wm).withColumn("lateness", status).drop("_seen")


def split_late(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows the windows accept, rows for the late side output)."""
    return df.where("lateness <> 'too_late'"), df.where("lateness = 'too_late'")
