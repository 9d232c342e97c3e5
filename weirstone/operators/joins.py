"""Joins, unions and connected inputs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from weirstone.functions.timecols import epoch_micros, micros_of
from weirstone.operators.running import DEFAULT_BLOCKS, Blocks, last_known, running


def union_all(*frames: DataFrame) -> DataFrame:
    """Append inputs of equal columns; duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def connect(left: DataFrame, right: DataFrame, left_map: Sequence[Column], right_map: Sequence[Column]) -> DataFrame:
    """Two differently typed inputs, one projection each, one output with a `_side` tag."""
    return left.select(F.lit("left").alias("_side"), *left_map).unionByName(
        right.select(F.lit("right").alias("_side"), *right_map)
    )


def _within(left_ts: str, right_ts: str, lower_us: int, upper_us: int) -> Column:
    gap = epoch_micros(right_ts) - epoch_micros(left_ts)
    return gap.between(lower_us, upper_us)


def match_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join without a time bound; Spark sizes the sides and splits skewed ones."""
    return left.join(right, list(keys), how)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    lower: str,
    upper: str,
    bucketed: bool = True,
) -> DataFrame:
    """Pairs with right_ts - left_ts in [lower, upper], both ends included.

    Column names other than the keys must differ. On a bounded input the time axis
    is cut into buckets of the interval's length and the bucket joins the equi-key:
    a left row goes to the one or two buckets its interval touches, a right row to
    its own. A hot key is thereby spread over its time range, and its rows are
    compared with near ones only. Streams use the plain condition, which Spark
    turns into state bounds.
    """
    lower_us, upper_us = _signed_micros(lower), _signed_micros(upper)
    keys = list(keys)
    if left.isStreaming or right.isStreaming:
        on = [left[k] == right[k] for k in keys]
        bounds = (
            right[right_ts] >= left[left_ts] + F.expr(f"INTERVAL '{lower_us / 1e6:f}' SECOND")
        ) & (right[right_ts] <= left[left_ts] + F.expr(f"INTERVAL '{upper_us / 1e6:f}' SECOND"))
        joined = left.join(right, reduce(lambda a, b: a & b, [*on, bounds]), "inner")
        return joined.drop(*[right[k] for k in keys])
    condition = _within(left_ts, right_ts, lower_us, upper_us)
    if not bucketed:
        return left.join(right, keys, "inner").where(condition)
    width = max(upper_us - lower_us, 1)

    def bucket(us: Column) -> Column:
        return us - F.pmod(us, F.lit(width))

    lts, rts = epoch_micros(left_ts), epoch_micros(right_ts)
    spread = left.withColumn(
        "_bucket", F.explode(F.sequence(bucket(lts + lower_us), bucket(lts + upper_us), F.lit(width)))
    )
    placed = right.withColumn("_bucket", bucket(rts))
    return spread.join(placed, [*keys, "_bucket"], "inner").where(condition).drop("_bucket")


def _signed_micros(duration: str) -> int:
    text = duration.strip()
    return -micros_of(text[1:].strip()) if text.startswith("-") else micros_of(text)


def reconcile(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str],
    left_id: str,
    right_id: str,
    left_ts: str,
    right_ts: str,
    lower: str,
    upper: str,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matched pairs, left rows without a partner, right rows without a partner).

    The unmatched sides are anti-joins on the unique row ids: a full outer join on
    the key could not be split when the key is hot.
    """
    pairs = interval_join(
        left, right, keys=keys, left_ts=left_ts, right_ts=right_ts, lower=lower, upper=upper
    )
    lonely_left = left.join(pairs.select(left_id).distinct(), left_id, "left_anti")
    lonely_right = right.join(pairs.select(right_id).distinct(), right_id, "left_anti")
    return pairs, lonely_left, lonely_right


def control_switch(
    data: DataFrame,
    control: DataFrame,
    *,
    seq: str,
    value: str,
    name: str = "switch",
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """Each data row with the latest control value that arrived before it.

    Control and data are one tagged sequence; the control value is carried along
    it block by block, so neither side is collected or broadcast.
    """
    tagged = data.select("*", F.lit(None).cast(control.schema[value].dataType).alias("_ctl"))
    marks = control.select(
        *[
            F.col(seq) if f.name == seq else F.lit(None).cast(f.dataType).alias(f.name)
            for f in data.schema.fields
        ],
        F.col(value).alias("_ctl"),
    )
    both = tagged.withColumn("_data", F.lit(True)).unionByName(marks.withColumn("_data", F.lit(False)))
    out = running(both, keys=[], order=[seq], folds={name: last_known(F.col("_ctl"))}, blocks=blocks)
    return out.where("_data").drop("_data", "_ctl")


def changelog_rows(keys: Sequence[str], pairs: DataFrame, padded: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """Changelog (keys, step, added, left id, right id) of pairs and of padded left rows with their `_first` partner."""
    none = F.lit(None).cast(pairs.schema[right_id].dataType).alias(right_id)
    made = pairs.select(*keys, F.greatest(left_id, right_id).alias("step"), F.lit(True).alias("added"), left_id, right_id)
    alone = padded.where("_own").select(*keys, F.col(left_id).alias("step"), F.lit(True).alias("added"), left_id, none)
    back = padded.where(F.col("_first").isNotNull()).select(*keys, F.col("_first").alias("step"), F.lit(False).alias("added"), left_id, none)
    return made.unionByName(alone).unionByName(back)


def first_partners(left: DataFrame, pairs: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """`left` with `_first`, the partner of a row that came first, null without one."""
    firsts = pairs.groupBy(F.col(left_id).alias("_left")).agg(F.min(right_id).alias("_first"))
    return left.join(firsts, F.col(left_id) == F.col("_left"), "left").drop("_left")


def left_join_changelog(
    left: DataFrame, right: DataFrame, *, keys: Sequence[str], left_id: str, right_id: str, left_ts: str, right_ts: str, keep: str
) -> DataFrame:
    """Left join as a changelog: (keys, step, added, left id, right id), a null right id being the padded row.

    The ids are arrival numbers, unique over both inputs; `step` is the arrival that puts a
    row out. A left row that finds no partner is put out padded, and retracted (`added`
    False) when the first one arrives. A row is kept for `keep` of event time: two rows
    farther apart never meet, in whichever order they come. The pairs come from
    `interval_join`, so a hot key is spread over its time; first partners are minima.
    """
    keys = list(keys)
    own = left.select(*keys, left_id, left_ts)
    pairs = interval_join(own, right.select(*keys, right_id, right_ts), keys=keys, left_ts=left_ts, right_ts=right_ts, lower=f"-{keep}", upper=keep)
    found = first_partners(own, pairs, left_id, right_id)
    padded = found.where(F.col("_first").isNull() | (F.col("_first") > F.col(left_id))).withColumn("_own", F.lit(True))
    return changelog_rows(keys, pairs, padded, left_id, right_id)
