"""Hot items and hot URLs: the most frequent values per sliding window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from weirstone.functions.timecols import micros_of
from weirstone.operators.late import classify_lateness, split_late
from weirstone.operators.over import top_n, top_n_batches
from weirstone.operators.windows import count_rows, dense_hop
from weirstone.streaming.runner import drain


def hot_items(df: DataFrame, *, item: str, ts: str, size: str, slide: str, n: int) -> DataFrame:
    """Top-`n` items per sliding window: (item, window_end, ct, rk)."""
    counts = dense_hop(df, keys=[item], ts=ts, size=size, slide=slide, measures={"ct": count_rows()})
    return top_n(counts, keys=["window_end"], by="ct", ties=[item], n=n).select(item, "window_end", "ct", "rk")


def stream_hot_items(
    df: DataFrame, *, item: str, ts: str, size: str, slide: str, n: int, delay: str,
    write: Callable[[DataFrame, int], None], checkpoint: str | None = None,
) -> None:
    """The same list from a stream, each window ranked when the watermark closes it."""
    counts = (
        df.withWatermark(ts, delay)
        .groupBy(F.window(ts, size, slide).alias("w"), item)
        .agg(F.count(F.lit(1)).alias("ct"))
        .select(item, F.col("w.end").alias("window_end"), "ct")
    )
    drain(
        counts, top_n_batches(write, keys=["window_end"], by="ct", ties=[item], n=n), mode="append",
        checkpoint=checkpoint,
    )


def parse_access_line(line: Column) -> list[Column]:
    """ip, user, time, method and url of a space-separated access-log line."""
    parts = F.split(line, " ")
    return [
        parts[0].alias("ip"),
        parts[1].alias("user"),
        F.to_timestamp_ntz(parts[3], F.lit("dd/MM/yyyy:HH:mm:ss")).alias("ts"),
        parts[5].alias("method"),
        parts[6].alias("url"),
    ]


def hot_urls(
    df: DataFrame, *, url: str, ts: str, order: list[str], size: str, slide: str, delay: str, lateness: str, n: int
) -> DataFrame:
    """Top-`n` URLs per sliding window with late rows admitted for `lateness`.

    A late row still counts in those of its windows that were open when it came;
    the final list of each window is put out once.
    """
    seen = classify_lateness(df, ts=ts, order=order, size=size, slide=slide, delay=delay, lateness=lateness)
    accepted, _ = split_late(seen)
    # Window [s, s + size) is closed once s + size + lateness <= watermark.
    closed = F.col("_wm") - micros_of(lateness) - micros_of(size)
    counts = dense_hop(
        accepted, keys=[url], ts=ts, size=size, slide=slide, measures={"ct": count_rows()}, open_after=closed
    )
    return top_n(counts, keys=["window_end"], by="ct", ties=[url], n=n).select(url, "window_end", "ct", "rk")
