"""Event-sequence patterns on bounded tables.

Pattern forms follow event time (`order` = [ts, arrival]); the pair form follows
arrival. Their streaming twins are in `streaming.processors`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from weirstone.functions.timecols import epoch_micros, from_micros, micros_of
from weirstone.operators.running import (
    DEFAULT_BLOCKS,
    Blocks,
    cut_rows,
    last_known,
    last_known_before,
    previous,
    running,
    trailing_rows,
)


def strict_repeat(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    matches: Column,
    times: int,
    within: str,
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """`times` consecutive matching rows of a key in less than `within`; matches overlap.

    One output row per match: keys, first_ts, last_ts.
    """
    ts = order[0]
    rows = df.select(*keys, *order, matches.alias("_hit"))
    framed = trailing_rows(
        rows,
        keys=keys,
        order=order,
        preceding=times - 1,
        aggs={"_all": F.bool_and("_hit"), "_held": F.count(F.lit(1)), "first_ts": F.first(ts)},
        number="_n",
        blocks=blocks,
    )
    span = epoch_micros(ts) - epoch_micros("first_ts")
    return framed.where(
        F.col("_all") & (F.col("_held") == times) & (span < micros_of(within))
    ).select(*keys, "first_ts", F.col(ts).alias("last_ts"))


def followed_by(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    starts: Column,
    ends: Column,
    within: str,
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> tuple[DataFrame, DataFrame]:
    """(matched, timed out) for a start followed, not necessarily at once, by an end.

    matched: keys, start_ts, end_ts; timed out: keys, start_ts, timeout_ts.
    """
    ts = order[0]
    rows = df.where(starts | ends).select(*keys, *order, starts.alias("_s"), ends.alias("_e"))
    ahead = running(
        rows,
        keys=keys,
        order=order,
        folds={"_end": last_known_before(F.when(F.col("_e"), epoch_micros(ts)))},
        blocks=blocks,
        reverse=True,
    ).where("_s")
    us = epoch_micros(ts)
    in_time = F.coalesce(F.col("_end") - us < micros_of(within), F.lit(False))
    matched = ahead.where(in_time).select(
        *keys, F.col(ts).alias("start_ts"), from_micros(F.col("_end")).alias("end_ts")
    )
    late = ahead.where(~in_time).select(
        *keys, F.col(ts).alias("start_ts"), from_micros(us + micros_of(within)).alias("timeout_ts")
    )
    return matched, late


def pay_monitor(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    creates: Column,
    pays: Column,
    within: str,
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(paid, paid without an open create, created and not paid).

    A pay closes the create just before it when it comes at most `within` later;
    any other pay has no create. A create is unpaid when nothing follows it within
    that time; a newer create replaces it.
    """
    ts, limit = order[0], micros_of(within)
    rows = df.where(creates | pays).select(
        *keys, *order, creates.alias("_create"), epoch_micros(ts).alias("_us")
    )
    rows, blocks = cut_rows(rows, keys, ts, blocks)
    back = running(
        rows,
        keys=keys,
        order=order,
        folds={"_prev": previous(F.struct("_create", "_us"))},
        blocks=blocks,
    ).where("NOT _create")
    open_create = F.coalesce(
        F.col("_prev._create") & (F.col("_us") - F.col("_prev._us") <= limit), F.lit(False)
    )
    paid = back.where(open_create).select(
        *keys, from_micros(F.col("_prev._us")).alias("create_ts"), F.col(ts).alias("pay_ts")
    )
    stray = back.where(~open_create).select(*keys, F.col(ts).alias("pay_ts"))
    ahead = running(
        rows, keys=keys, order=order, folds={"_next": previous(F.col("_us"))}, blocks=blocks, reverse=True
    ).where("_create")
    unpaid = ahead.where(
        F.col("_next").isNull() | (F.col("_next") - F.col("_us") > limit)
    ).select(
        *keys, F.col(ts).alias("create_ts"), from_micros(F.col("_us") + limit).alias("timeout_ts")
    )
    return paid, stray, unpaid


def fails_in_window(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    fails: Column,
    within: str,
    at_least: int,
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """The first fail after a success opens a window; report it with >= `at_least` fails.

    The window closes `within` after its first fail (included), or at a success.
    """
    ts = order[0]
    rows = df.select(*keys, *order, fails.alias("_fail"), epoch_micros(ts).alias("_us"))
    rows, blocks = cut_rows(rows, keys, ts, blocks)
    marked = running(
        rows, keys=keys, order=order, folds={"_before": previous(F.col("_fail"))}, blocks=blocks,
        keep_block=True,
    )
    opens = F.col("_fail") & ~F.coalesce(F.col("_before"), F.lit(False))
    opened = running(
        marked,
        keys=keys,
        order=order,
        folds={"_open": last_known(F.when(opens, F.struct("_us", *order)))},
        blocks=blocks,
    )
    inside = opened.where(F.col("_fail") & (F.col("_us") - F.col("_open._us") <= micros_of(within)))
    return (
        inside.groupBy(*keys, "_open")
        .agg(F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("fails"))
        .where(F.col("fails") >= at_least)
        .select(*keys, from_micros(F.col("_open._us")).alias("first_ts"), "last_ts", "fails")
    )


def fail_pairs(
    df: DataFrame,
    *,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    fails: Column,
    within: str,
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """Two fails next to each other in arrival order, at most `within` apart."""
    rows = df.select(*keys, *dict.fromkeys([*order, ts]), fails.alias("_fail"), epoch_micros(ts).alias("_us"))
    marked = running(
        rows,
        keys=keys,
        order=order,
        folds={"_prev": previous(F.struct("_fail", "_us"))},
        blocks=blocks,
    )
    near = F.abs(F.col("_us") - F.col("_prev._us")) <= micros_of(within)
    return marked.where(F.col("_fail") & F.col("_prev._fail") & near).select(
        *keys, *order, from_micros(F.col("_prev._us")).alias("first_ts"), from_micros(F.col("_us")).alias("last_ts")
    )


def no_drop_alerts(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    hold: str,
    strict: bool = False,
    rearm: bool = False,
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """Runs in which `value` does not drop for longer than `hold`, one alert per run.

    A run starts at a key's first row, or at the first row after a drop that is not
    a drop itself, and lasts until the next drop. With `strict`, an equal value
    counts as a drop.

    With `rearm` an alert starts a new wait: at the run's first row later than the alert,
    which alerts again if the run lasts. `run_start` is then the row that began the wait.
    Only rows that could alert are brought together, by run; a run passes through a task as a
    stream that holds one time.
    """
    ts, hold_us = order[0], micros_of(hold)
    rows = df.select(*keys, *order, F.col(value).alias("_v"), epoch_micros(ts).alias("_us"))
    rows, blocks = cut_rows(rows, keys, ts, blocks)
    stepped = running(
        rows, keys=keys, order=order, folds={"_prev": previous(F.col("_v"))}, blocks=blocks, keep_block=True
    )
    falls = F.col("_v") <= F.col("_prev") if strict else F.col("_v") < F.col("_prev")
    flagged = stepped.withColumn("_drop", F.coalesce(falls, F.lit(False)))
    ahead = running(
        flagged,
        keys=keys,
        order=order,
        folds={
            "_next": previous(F.struct("_us", "_drop")),
            "_until": last_known_before(F.when(F.col("_drop"), F.col("_us"))),
        },
        blocks=blocks,
        reverse=True,
    )
    if rearm:
        armed = ahead.where(~F.col("_drop") & (F.col("_until").isNull() | (F.col("_until") > F.col("_us") + hold_us)))
        return _alerts(_chained(armed.select(*keys, "_until", "_us").distinct(), list(keys), hold_us), keys, hold_us)
    start = F.when(F.col("_prev").isNull(), F.col("_us")).when(
        F.col("_drop") & ~F.col("_next._drop"), F.col("_next._us")
    )
    runs = ahead.select(*keys, start.alias("_start"), "_until").where(F.col("_start").isNotNull())
    lasting = runs.where(F.col("_until").isNull() | (F.col("_until") > F.col("_start") + hold_us))
    return _alerts(lasting, keys, hold_us)


def _alerts(waits: DataFrame, keys: Sequence[str], hold_us: int) -> DataFrame:
    return waits.select(*keys, from_micros(F.col("_start")).alias("run_start"), from_micros(F.col("_start") + hold_us).alias("alert_at"))


def _chained(rows: DataFrame, keys: list[str], hold_us: int) -> DataFrame:
    """(keys, _start): of each run its first row, and on and on the first row more than `hold_us` after the one before.

    The next drop (`_until`) tells runs apart: no other run of the key with a row here has the same.
    """
    by = [*keys, "_until"]
    schema = StructType([*[rows.schema[k] for k in keys], StructField("_start", LongType())])
    places = [rows.columns.index(c) for c in by]
    at = rows.columns.index("_us")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = since = None
        for batch in batches:
            taken = []
            groups = zip(*(batch.column(i).to_pylist() for i in places))
            for i, (own, us) in enumerate(zip(groups, batch.column(at).to_pylist())):
                if own != group:
                    group, since = own, None
                if since is None or us > since + hold_us:
                    since = us
                    taken.append(i)
            kept = batch.take(pa.array(taken, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column(i) for i in (*places[:-1], at)], names=schema.fieldNames())

    return rows.repartition(*by).sortWithinPartitions(*by, "_us").mapInArrow(run, schema)
