"""Every firing of windows that late rows fire again.

A window fires when the watermark passes its end, with the rows that came until then, and
once more at each late row that it still accepts. On-time rows are only aggregated, map-side
combined; the running values are made for the late rows alone, which are few.

The folds used here have a result of the same kind as their totals: counts, sums, maxima and
minima.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from weirstone.functions.timecols import epoch_micros, floor_to, from_micros, micros_of
from weirstone.operators.late import classify_lateness
from weirstone.operators.over import top_n
from weirstone.operators.running import DEFAULT_BLOCKS, Blocks, Fold, running, running_count, same_keys
from weirstone.operators.windows import count_rows, dense_hop

# Columns of a window's totals: rows that came in time, late rows since, and the folds.
ON_TIME, LATE, START = "_on_time", "_n_late", "_start"


def window_totals(rows: DataFrame, *, keys: Sequence[str], order: Sequence[str], folds: dict[str, Fold]) -> DataFrame:
    """One row per key and window start: number of rows, and the fold of all of them."""
    rank = F.struct(*order)
    return rows.groupBy(*keys, START).agg(F.count(F.lit(1)).alias(ON_TIME), *[f.total(rank, False).alias(n) for n, f in folds.items()])


def fold_late(
    late: DataFrame, totals: DataFrame, *, keys: Sequence[str], order: Sequence[str], folds: dict[str, Fold], blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """The value of its window after each late row: keys, start, `order`, `firing` and the folds.

    `totals` holds what came before, windows without any row left out: firings so far are
    its late rows, and one for the rows in time.
    """
    by, names = [*keys, START], [f"_j{i}" for i in range(len(keys) + 1)]
    own = {f"_f{i}": f for i, f in enumerate(folds.values())}
    values = running(late, keys=by, order=order, folds={**own, "_n": running_count()}, blocks=blocks)
    before = totals.select(*[F.col(k).alias(n) for k, n in zip(by, names)], ON_TIME, LATE, *[F.col(n).alias(f"_b{i}") for i, n in enumerate(folds)])
    joined = values.join(before, same_keys(by, names), "left")
    fired = F.coalesce(LATE, F.lit(0)) + F.when(F.col(ON_TIME) > 0, 1).otherwise(0)
    merged = [f.merge(F.col(f"_b{i}"), F.col(f"_f{i}")).alias(n) for i, (n, f) in enumerate(folds.items())]
    return joined.select(*by, *order, (fired + F.col("_n")).alias("firing"), *merged)


def labelled(firings: DataFrame, keys: Sequence[str], size_us: int, folds: Sequence[str]) -> DataFrame:
    return firings.select(*keys, from_micros(F.col(START)).alias("window_start"), from_micros(F.col(START) + size_us).alias("window_end"), "firing", *folds)


def late_firings(
    df: DataFrame, *, keys: Sequence[str], ts: str, order: Sequence[str], size: str, delay: str, lateness: str, folds: dict[str, Fold],
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """(keys, window_start, window_end, firing, folds) of tumbling windows, firings numbered from 1.

    Rows later than `lateness` change nothing. The end of the table counts as the end of
    time: every window that holds rows in time has fired by then.
    """
    keys, size_us = list(keys), micros_of(size)
    judged = classify_lateness(df, ts=ts, order=order, size=size, delay=delay, lateness=lateness, blocks=blocks)
    placed = judged.where("lateness <> 'too_late'").withColumn(START, floor_to(epoch_micros(ts), size_us))
    totals = window_totals(placed.where("lateness = 'on_time'"), keys=keys, order=order, folds=folds).withColumn(LATE, F.lit(0).cast("long"))
    # A total stands for the value after its last row.
    first = totals.select(*keys, START, F.lit(1).cast("long").alias("firing"), *[f.merge(F.lit(None), F.col(n)).alias(n) for n, f in folds.items()])
    again = fold_late(placed.where("lateness = 'late'"), totals, keys=keys, order=order, folds=folds, blocks=blocks)
    return labelled(first.unionByName(again.select(*first.columns)), keys, size_us, list(folds))


# Re-ranked lists -----------------------------------------------------------------------------

# Updates of one window that one task ranks in a row.
RANK_BLOCK = 1 << 16
_RANKED = "w long, block long, version long, item string, ct long, kind int"
SEED, UPDATE = 0, 1


def placed_in(top: list[tuple[int, str]], item: str, ct: int, n: int) -> None:
    """Bring a grown count into the list of (-count, item), best first."""
    for i, (_, held) in enumerate(top):
        if held == item:
            del top[i]
            break
    else:
        if len(top) == n and (-ct, item) > top[-1]:
            return
    at = len(top)
    while at and top[at - 1] > (-ct, item):
        at -= 1
    top.insert(at, (-ct, item))
    del top[n:]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _carried(n: int):
    """Of each block its list before the first update, from sorted block summaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, top, out = None, [], []
        for w, block, _, item, ct, _ in _groups(batches):
            if at is None or at[0] != w:
                top = []
            if at != (w, block):
                out += [(w, block, 0, held, -c, SEED) for c, held in top]
                at = (w, block)
            placed_in(top, item, ct, n)
            if len(out) > 10_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32())
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["w", "block", "version", "item", "ct", "kind"])


def _reranked(n: int):
    """Of each update the list after it, `kind` being the rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, top, out = None, [], []
        for w, block, version, item, ct, kind in _groups(batches):
            if at != (w, block):
                at, top = (w, block), []
            placed_in(top, item, ct, n)
            if kind == UPDATE:
                out += [(w, block, version, held, -c, rank) for rank, (c, held) in enumerate(top, 1)]
            if len(out) > 10_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    return run


def reranked(base: DataFrame, updates: DataFrame, *, n: int, block: int = RANK_BLOCK) -> DataFrame:
    """(w, version, rk, item, ct): the `n` best items of a window after each of its updates.

    `base` (w, item, ct) are the `n` best before the first update, `updates` (w, version, item,
    ct) the grown counts, versions counting up from one more than 0 or 1. As counts only
    grow, a list of `n` is all that has to be kept of a window. The updates of a window are
    cut into blocks: the best of each block make the lists with which the next ones begin.
    """
    cut = F.floor(F.col("version") / block).cast("long")
    moves = updates.select("w", cut.alias("block"), "version", "item", "ct", F.lit(UPDATE).alias("kind"))
    start = base.join(moves.groupBy("w").agg(F.min("block").alias("block")), "w").select("w", "block", F.lit(0).cast("long").alias("version"), "item", "ct", F.lit(SEED).alias("kind"))
    best = top_n(moves.groupBy("w", "block", "item").agg(F.max("ct").alias("ct")), keys=["w", "block"], by="ct", ties=["item"], n=n)
    # A block's own best count from the one after it on; base lists come before the first block.
    summaries = best.select("w", "block", F.lit(1).cast("long").alias("version"), "item", "ct", F.lit(SEED).alias("kind"))
    along = ["w", "block", "version"]
    seeds = start.unionByName(summaries).repartition("w").sortWithinPartitions(*along).mapInArrow(_carried(n), _RANKED)
    rows = moves.unionByName(seeds).unionByName(start).repartition("w", "block").sortWithinPartitions("w", "block", "version", "kind")
    found = rows.mapInArrow(_reranked(n), _RANKED)
    return found.select("w", "version", F.col("kind").alias("rk"), "item", "ct")


def hot_versions(
    df: DataFrame, *, item: str, ts: str, order: Sequence[str], size: str, slide: str, delay: str, lateness: str, n: int,
    blocks: Blocks | None = DEFAULT_BLOCKS, rank_block: int = RANK_BLOCK,
) -> DataFrame:
    """(item, window_end, version, ct, rk): the top list of each sliding window, and again after each late row.

    Version 1 counts the rows that came before the watermark passed the window's end (none
    where there is no such row); each late row that the window still accepts makes the next.
    """
    size_us, slide_us, late_us = micros_of(size), micros_of(slide), micros_of(lateness)
    seen = classify_lateness(df, ts=ts, order=order, size=size, slide=slide, delay=delay, lateness=lateness, blocks=blocks)
    rows = seen.where(F.col(item).isNotNull()).select(F.col(item).alias("item"), ts, *order, "_wm")
    # Windows that start at or before this have fired when the row comes.
    fired = F.col("_wm") - size_us
    counts = dense_hop(rows, keys=["item"], ts=ts, size=size, slide=slide, measures={"ct": count_rows()}, open_after=fired)
    counts = counts.select("item", epoch_micros("window_start").alias("w"), "ct")
    base = top_n(counts, keys=["w"], by="ct", ties=["item"], n=n)
    us = epoch_micros(ts)
    low = F.greatest(floor_to(us - size_us, slide_us), floor_to(fired - late_us, slide_us)) + slide_us
    high = F.least(floor_to(us, slide_us), floor_to(fired, slide_us))
    late = rows.withColumns({"_low": low, "_high": high}).where("_wm IS NOT NULL AND _low <= _high")
    late = late.select("item", *order, F.explode(F.sequence("_low", "_high", F.lit(slide_us))).alias("w"))
    nth = running(late, keys=["w", "item"], order=order, folds={"_own": running_count()}, blocks=blocks)
    nth = running(nth, keys=["w"], order=order, folds={"_nth": running_count()}, blocks=blocks)
    before = counts.select(F.col("w").alias("_w"), F.col("item").alias("_item"), F.col("ct").alias("_ct"))
    grown = nth.join(before, (F.col("w") == F.col("_w")) & (F.col("item") == F.col("_item")), "left")
    grown = grown.select("w", "item", "_nth", (F.col("_own") + F.coalesce("_ct", F.lit(0))).alias("ct"))
    opened = counts.groupBy(F.col("w").alias("_w")).agg(F.lit(1).alias("_base"))
    grown = grown.join(opened, F.col("w") == F.col("_w"), "left")
    updates = grown.select("w", (F.col("_nth") + F.coalesce("_base", F.lit(0))).alias("version"), "item", "ct")
    first = base.select("w", F.lit(1).cast("long").alias("version"), F.col("rk").cast("int").alias("rk"), "item", "ct")
    again = reranked(base.select("w", "item", "ct"), updates, n=n, block=rank_block)
    lists = first.unionByName(again)
    return lists.select(F.col("item").alias(item), from_micros(F.col("w") + size_us).alias("window_end"), "version", "ct", "rk")
