"""Row-count windows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weirstone.operators.running import DEFAULT_BLOCKS, Blocks, numbered, trailing_rows


def count_tumble(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    aggs: dict[str, Column],
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """Fires at every `size`-th row of a key; an incomplete tail is never put out."""
    rows = numbered(df, keys=keys, order=order, name="_n", blocks=blocks)
    window_no = F.floor((F.col("_n") - 1) / F.lit(size)).cast("long")
    return (
        rows.groupBy(*keys, window_no.alias("window_no"))
        .agg(F.count(F.lit(1)).alias("_held"), *[a.alias(n) for n, a in aggs.items()])
        .where(F.col("_held") == size)
        .drop("_held")
    )


def count_slide(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    slide: int,
    aggs: dict[str, Column],
    full_only: bool = False,
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """Fires at every `slide`-th row of a key over its last `size` rows.

    The first firings see fewer rows; `full_only` keeps windows of `size` rows.
    """
    rows = trailing_rows(
        df, keys=keys, order=order, preceding=size - 1, aggs=aggs, number="fired_at", blocks=blocks
    )
    fired = rows.where(F.pmod(F.col("fired_at"), F.lit(slide)) == 0)
    if full_only:
        fired = fired.where(F.col("fired_at") >= size)
    return fired.select(*keys, "fired_at", *aggs)
