"""Time windows: tumbling, sliding, session, and early results.

`df.isStreaming` needs no switch for tumbling and sliding windows: the same
grouped plan runs in both, with a watermark set by the caller for streams.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DecimalType, FractionalType

from weirstone.functions.timecols import epoch_micros, floor_to, from_micros, micros_of
from weirstone.operators.running import (
    BLOCK,
    DEFAULT_BLOCKS,
    Blocks,
    WHOLE,
    Fold,
    cut_rows,
    running,
    same_keys,
)


# Slides in a stretch of the running sum of `_restricted_hop`.
TIME_STEPS = 1 << 14


@dataclass(frozen=True)
class Measure:
    """A mergeable aggregate: `partial` over rows, `final` over partials.

    `subtract` tells whether a running difference gives the window value, where the
    partial is of an exact type; `held` counts the rows that have a value, without
    which the value is null.
    """

    partial: Column
    final: str
    subtract: bool = False
    held: Column | None = None

    def merge(self, name: str) -> Column:
        return getattr(F, self.final)(name)


def count_rows() -> Measure:
    return Measure(F.count(F.lit(1)), "sum", subtract=True)


def count_of(x: Column | str) -> Measure:
    return Measure(F.count(x), "sum", subtract=True)


def sum_of(x: Column | str) -> Measure:
    return Measure(F.sum(x), "sum", subtract=True, held=F.count(x))


def max_of(x: Column | str) -> Measure:
    return Measure(F.max(x), "max")


def min_of(x: Column | str) -> Measure:
    return Measure(F.min(x), "min")


def window_aggregate(
    df: DataFrame,
    *,
    keys: Sequence[str],
    ts: str,
    size: str,
    slide: str | None = None,
    aggs: dict[str, Column],
) -> DataFrame:
    """Tumbling (`slide` None) or sliding windows through Spark's own `window`.

    Suited to a low size/slide ratio; see `dense_hop` for many panes per row.
    """
    pane = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = df.groupBy(*keys, pane.alias("window")).agg(*[a.alias(n) for n, a in aggs.items()])
    return grouped.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *aggs,
    )


def dense_hop(
    df: DataFrame,
    *,
    keys: Sequence[str],
    ts: str,
    size: str,
    slide: str,
    measures: dict[str, Measure],
    open_after: Column | None = None,
) -> DataFrame:
    """Sliding windows with many panes per row (1 h every 5 s is 720).

    Rows are never copied per pane. They are first reduced to slices of the time unit
    that size and slide have in common. Time is cut into blocks of one window length: a
    pane begins in one block and ends in the next, so its value is that of the slices from
    its start to the end of the first (a suffix) merged with those of the second up to its
    end (a prefix). Suffixes and prefixes are running aggregates within (key, block), which
    never holds more than twice the slices of a window, so no key is too large for a task. Nothing is
    subtracted: maxima, minima and sums of doubles work as counts do. A value holds until
    the next slice enters or leaves, and only there it is put out pane by pane.

    A pane without any value of a sum has null.
    `open_after` (microseconds, null for none) keeps a row out of the panes that
    start at or before it: the windows a late row finds closed. Then see `_restricted_hop`.
    """
    size_us, slide_us = micros_of(size), micros_of(slide)
    if open_after is not None or slide_us > size_us:
        return _restricted_hop(df, keys=keys, ts=ts, size_us=size_us, slide_us=slide_us, measures=measures, open_after=open_after)
    unit, keys = gcd(size_us, slide_us), list(keys)
    parts, held_names = _with_helpers(measures)
    us = floor_to(epoch_micros(ts), unit)
    slices = df.where(F.col(ts).isNotNull()).groupBy(*keys, us.alias("_t")).agg(*[m.partial.alias(n) for n, m in parts.items()])
    # A slice counts for the panes of its own block that start up to it, and for those of the
    # block before that start after the slice a window length earlier.
    none = [F.lit(None).cast(slices.schema[n].dataType).alias(f"_p{i}") for i, n in enumerate(parts)]
    own = F.struct(F.col("_t").alias("x"), *[F.col(n).alias(f"_s{i}") for i, n in enumerate(parts)], *none)
    none = [F.lit(None).cast(slices.schema[n].dataType).alias(f"_s{i}") for i, n in enumerate(parts)]
    before = F.struct((F.col("_t") - size_us).alias("x"), *none, *[F.col(n).alias(f"_p{i}") for i, n in enumerate(parts)])
    marks = slices.select(*keys, F.explode(F.array(own, before)).alias("m")).select(*keys, floor_to(F.col("m.x"), size_us).alias("_block"), "m.*")
    one = lambda c: F.max(c).alias(c)  # noqa: E731 at most one slice stands at a place
    marks = marks.repartition(*keys, "_block").groupBy(*keys, "_block", "x").agg(*[one(f"{s}{i}") for i in range(len(parts)) for s in ("_s", "_p")])
    along = Window.partitionBy(*keys, "_block").orderBy("x")
    back = Window.partitionBy(*keys, "_block").orderBy(F.desc("x"))
    merges = list(parts.values())
    # Panes after the place before, up to this one.
    upto, begin = along.rowsBetween(Window.unboundedPreceding, -1), F.lag("x").over(along)
    stretches = marks.select(
        *keys, "_block", F.coalesce(begin, F.col("_block") - 1).alias("_after"), F.col("x").alias("_upto"), F.lead("x").over(along).isNull().alias("_end"),
        *[getattr(F, m.final)(f"_p{i}").over(upto).alias(f"_pre{i}") for i, m in enumerate(merges)],
        *[getattr(F, m.final)(f"_p{i}").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_all{i}") for i, m in enumerate(merges)],
        *[getattr(F, m.final)(f"_s{i}").over(back.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_suf{i}") for i, m in enumerate(merges)],
    )
    up = lambda us: floor_to(us, slide_us) + slide_us  # noqa: E731 the first pane start after a time

    def stretch(first: Column, last: Column, values: list[Column]) -> Column:
        return F.struct(first.alias("first"), last.alias("last"), *[v.alias(n) for v, n in zip(values, parts)])

    mixed = [_merged(m.final, F.col(f"_pre{i}"), F.col(f"_suf{i}")) for i, m in enumerate(merges)]
    here = stretch(up(F.col("_after")), floor_to(F.col("_upto"), slide_us), mixed)
    # After the last place of a block only what has entered counts, up to the block's end.
    rest = stretch(up(F.col("_upto")), floor_to(F.col("_block") + size_us - 1, slide_us), [F.col(f"_all{i}") for i in range(len(merges))])
    found = stretches.select(*keys, F.explode(F.when(F.col("_end"), F.array(here, rest)).otherwise(F.array(here))).alias("r")).select(*keys, "r.*")
    found = found.where("_rows > 0 AND first <= last")
    panes = found.withColumn("pane", F.explode(F.sequence("first", "last", F.lit(slide_us))))
    return _pane_rows(panes, keys, size_us, measures, held_names)


def _merged(final: str, a: Column, b: Column) -> Column:
    """Two partial values as one; null is none."""
    return {"max": F.greatest, "min": F.least}[final](a, b) if final != "sum" else F.coalesce(a + b, a, b)


def _with_helpers(measures: dict[str, Measure]) -> tuple[dict[str, Measure], dict[str, str]]:
    """The measures, the number of rows (a pane is put out while it holds some), and that of a sum's values."""
    held_names = {n: f"_held_{n}" for n, m in measures.items() if m.held is not None}
    helpers = {"_rows": count_rows(), **{h: Measure(measures[n].held, "sum", subtract=True) for n, h in held_names.items()}}
    return {**measures, **helpers}, held_names


def _pane_rows(panes: DataFrame, keys: list[str], size_us: int, measures: dict[str, Measure], held_names: dict[str, str]) -> DataFrame:
    return panes.select(
        *keys,
        from_micros(F.col("pane")).alias("window_start"),
        from_micros(F.col("pane") + size_us).alias("window_end"),
        *[F.when(F.col(held_names[n]) > 0, F.col(n)).alias(n) if n in held_names else F.col(n) for n in measures],
    )


def _restricted_hop(
    df: DataFrame, *, keys: Sequence[str], ts: str, size_us: int, slide_us: int, measures: dict[str, Measure], open_after: Column | None
) -> DataFrame:
    """Sliding windows whose rows count in some of their panes only, as late rows do.

    Rows are reduced to one per key and span of panes; for counts and exact sums each span
    enters at its first pane and leaves after its last, and a running sum over those change
    points gives the value, per key and stretch of TIME_STEPS slides, with what came before
    carried over. Other measures copy the spans, not the rows.
    """
    unit = gcd(size_us, slide_us)
    keys = list(keys)
    parts, held_names = _with_helpers(measures)
    us = floor_to(epoch_micros(ts), unit)
    # Panes start at multiples of slide in (slice - size, slice]; slices lie on the unit grid.
    first = floor_to(us - size_us + slide_us, slide_us)
    if open_after is not None:
        first = F.greatest(first, floor_to(open_after, slide_us) + slide_us)
    slices = (
        df.select("*", first.alias("_first"), floor_to(us, slide_us).alias("_last"))
        .where("_first <= _last")
        .groupBy(*keys, "_first", "_last")
        .agg(*[m.partial.alias(n) for n, m in parts.items()])
    )

    exact = all(not isinstance(slices.schema[n].dataType, FractionalType) or isinstance(slices.schema[n].dataType, DecimalType) for n in measures)
    if exact and all(m.subtract for m in measures.values()):
        def signed(sign: int, at: Column) -> Column:
            return F.struct(
                at.alias("pane"),
                *[(F.lit(sign) * F.coalesce(F.col(n), F.lit(0))).alias(n) for n in parts],
            )

        moves = slices.select(
            *keys, F.explode(F.array(signed(1, F.col("_first")), signed(-1, F.col("_last") + slide_us))).alias("m")
        ).select(*keys, "m.*")
        points = moves.groupBy(*keys, "pane").agg(*[F.sum(n).alias(n) for n in parts])
        points = points.withColumn("_stretch", F.floor(F.col("pane") / (slide_us * TIME_STEPS)))
        w = Window.partitionBy(*keys, "_stretch").orderBy("pane")
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = points.select(*keys, "_stretch", "pane", F.lead("pane").over(w).alias("_next"), *[F.sum(n).over(upto).alias(n) for n in parts])
        along = Window.partitionBy(*keys).orderBy("_stretch")
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        names = [f"_j{i}" for i in range(len(keys))]
        totals = points.groupBy(*keys, "_stretch").agg(F.min("pane").alias("_opens"), *[F.sum(n).alias(n) for n in parts])
        carried = totals.select(
            *[F.col(k).alias(j) for k, j in zip(keys, names)], F.col("_stretch").alias("_at"), F.lead("_opens").over(along).alias("_after"),
            *[F.sum(n).over(before).alias(f"_c_{n}") for n in parts],
        )
        joined = local.join(carried, same_keys(keys, names) & (F.col("_stretch") == F.col("_at")))
        held = joined.select(
            *keys, "pane", F.coalesce("_next", "_after").alias("_next"), *[(F.col(n) + F.coalesce(F.col(f"_c_{n}"), F.lit(0))).alias(n) for n in parts]
        ).where(F.col("_rows") > 0)
        panes = held.withColumn(
            "pane", F.explode(F.sequence(F.col("pane"), F.col("_next") - slide_us, F.lit(slide_us)))
        )
    else:
        panes = (
            slices.withColumn("pane", F.explode(F.sequence("_first", "_last", F.lit(slide_us))))
            .groupBy(*keys, "pane")
            .agg(*[m.merge(n).alias(n) for n, m in parts.items()])
        )
    return _pane_rows(panes, keys, size_us, measures, held_names)


def session_windows(
    df: DataFrame,
    *,
    keys: Sequence[str],
    ts: str,
    gap: str,
    measures: dict[str, Measure],
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """Session windows of a bounded table; rows exactly one gap apart still merge.

    Spark's `session_window` brings all rows of a key together. Here the sessions of
    a hot key are cut inside time blocks first; only what a block knows about its borders (first
    and last time, start of its last session) is folded across blocks, and partial
    sessions are then merged by their start. For a stream use `session_window`.
    """
    gap_us = micros_of(gap)
    keys = list(keys)
    timed = df.withColumn("_us", epoch_micros(ts))
    cut, blocks = cut_rows(timed, keys, "_us", blocks)
    group = [*keys, BLOCK] if blocks else keys
    w = Window.partitionBy(*group).orderBy("_us")
    marked = cut.withColumn(
        "_opens", F.when(F.col("_us") - F.lag("_us").over(w) > gap_us, F.col("_us"))
    ).withColumn("_start", F.max("_opens").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    # Head rows of a block have no start yet: their session may come from before.
    pieces = marked.groupBy(*group, "_start").agg(
        F.min("_us").alias("_from"),
        F.max("_us").alias("_to"),
        *[m.partial.alias(n) for n, m in measures.items()],
    )
    if blocks is None:
        return _labelled(pieces.withColumn("_begin", F.col("_from")), keys, gap_us, measures)
    borders = pieces.where(F.col(BLOCK) != WHOLE).groupBy(*keys, BLOCK).agg(
        F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.max("_start").alias("_last")
    )
    by_key = Window.partitionBy(*keys).orderBy(BLOCK)
    entries = (
        borders.withColumn("_prev", F.lag("_to").over(by_key))
        .withColumn(
            "_own",
            F.when(F.col("_prev").isNull() | (F.col("_from") - F.col("_prev") > gap_us), F.col("_from")),
        )
        .withColumn(
            "_carried",
            F.last(F.coalesce("_last", "_own"), ignorenulls=True).over(
                by_key.rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select(*keys, BLOCK, F.coalesce("_own", "_carried").alias("_entry"))
    )
    names = [f"_j{i}" for i in range(len(keys))]
    entries = entries.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(BLOCK).alias("_jb"), "_entry")
    whole = (
        pieces.join(entries, same_keys(keys, names) & (F.col(BLOCK) == F.col("_jb")), "left")
        .groupBy(*keys, F.coalesce("_start", "_entry", "_from").alias("_begin"))
        .agg(F.max("_to").alias("_to"), *[m.merge(n).alias(n) for n, m in measures.items()])
    )
    return _labelled(whole, keys, gap_us, measures)


def _labelled(sessions: DataFrame, keys: list[str], gap_us: int, measures: dict[str, Measure]) -> DataFrame:
    return sessions.select(
        *keys,
        from_micros(F.col("_begin")).alias("window_start"),
        from_micros(F.col("_to") + gap_us).alias("window_end"),
        *measures,
    )


def streaming_session(
    df: DataFrame, *, keys: Sequence[str], ts: str, gap: str, aggs: dict[str, Column]
) -> DataFrame:
    """The same windows on a watermarked stream."""
    return (
        df.groupBy(*keys, F.session_window(ts, gap).alias("window"))
        .agg(*[a.alias(n) for n, a in aggs.items()])
        .select(
            *keys,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *aggs,
        )
    )


def early_results(
    df: DataFrame,
    *,
    keys: Sequence[str],
    ts: str,
    size: str,
    order: Sequence[str],
    folds: dict[str, Fold],
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """A window that fires on every row: the running value inside its window."""
    start = floor_to(epoch_micros(ts), micros_of(size))
    placed = df.withColumn("window_start", from_micros(start)).withColumn(
        "window_end", from_micros(start + micros_of(size))
    )
    return running(
        placed, keys=[*keys, "window_start", "window_end"], order=order, folds=folds, blocks=blocks
    )
