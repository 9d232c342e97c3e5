"""Ad clicks per province, with a blacklist of too frequent clickers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weirstone.functions.timecols import local_day
from weirstone.operators.running import numbered
from weirstone.operators.windows import count_rows, dense_hop


def judge_clicks(
    clicks: DataFrame, *, user: str, ad: str, ts: str, order: list[str], limit: int, offset_hours: int = 8
) -> DataFrame:
    """Add `verdict`: the first `limit` - 1 clicks of a (user, ad, local day) pass,
    the next one raises an alert, the rest is dropped."""
    dated = clicks.withColumn("_day", local_day(ts, offset_hours))
    counted = numbered(dated, keys=[user, ad, "_day"], order=order, name="_n")
    verdict = F.when(F.col("_n") < limit, "pass").when(F.col("_n") == limit, "alert").otherwise("drop")
    return counted.withColumn("verdict", verdict).drop("_n", "_day")


def clicks_by_province(passed: DataFrame, *, province: str, ts: str, size: str = "1 hour", slide: str = "5 seconds") -> DataFrame:
    """Sliding click counts per province: (province, window_start, window_end, ct)."""
    return dense_hop(passed, keys=[province], ts=ts, size=size, slide=slide, measures={"ct": count_rows()})
