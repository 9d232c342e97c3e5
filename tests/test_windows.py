"""Time windows against loops over panes and gaps."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from data import START, by_key, feed, frame, sentinel, skewed, split, tuples, us
from weirstone.operators.running import Blocks, running_count
from weirstone.operators.windows import (
    count_rows,
    dense_hop,
    early_results,
    max_of,
    min_of,
    session_windows,
    streaming_session,
    sum_of,
    window_aggregate,
)
from weirstone.streaming.runner import appended_rows

ROWS = skewed(400)


def at(micros: int) -> datetime:
    return datetime(1970, 1, 1) + timedelta(microseconds=micros)


def panes(rows, size: int, slide: int):
    out: dict = {}
    for r in rows:
        start = us(r[2]) // slide * slide
        while start > us(r[2]) - size:
            out.setdefault((r[1], start), []).append(r[3])
            start -= slide
    return out


@pytest.mark.parametrize(
    "size,slide", [("10 minutes", "5 seconds"), ("90 seconds", "1 minute"), ("30 seconds", "45 seconds"), ("1 minute", "1 minute")]
)
def test_dense_hop(spark, size, slide):
    secs = {"10 minutes": 600, "5 seconds": 5, "90 seconds": 90, "1 minute": 60, "30 seconds": 30, "45 seconds": 45}
    want = panes(ROWS, secs[size] * 10**6, secs[slide] * 10**6)
    df = frame(spark, ROWS)
    sums = dense_hop(df, keys=["id"], ts="ts", size=size, slide=slide, measures={"n": count_rows(), "s": sum_of("vc")})
    assert tuples(sums, "id", "window_start", "n", "s") == sorted(
        ((k, at(p), len(v), sum(v)) for (k, p), v in want.items()), key=str
    )
    ends = dense_hop(df, keys=["id"], ts="ts", size=size, slide=slide, measures={"hi": max_of("vc"), "lo": min_of("vc")})
    assert tuples(ends, "id", "window_start", "hi", "lo") == sorted(
        ((k, at(p), max(v), min(v)) for (k, p), v in want.items()), key=str
    )


def test_dense_hop_copies_no_rows(spark):
    df = frame(spark, ROWS)
    hop = dense_hop(df, keys=["id"], ts="ts", size="1 hour", slide="5 seconds", measures={"n": count_rows()})
    plan = hop._jdf.queryExecution().executedPlan().toString()
    # The only sequence is expanded after the last aggregate.
    assert plan.index("sequence") < plan.index("HashAggregate")


def test_tumbling_and_sliding(spark):
    df = frame(spark, ROWS)
    for size, slide, width, step in [("5 seconds", None, 5, 5), ("6 seconds", "2 seconds", 6, 2)]:
        got = window_aggregate(df, keys=["id"], ts="ts", size=size, slide=slide, aggs={"s": F.sum("vc")})
        want = panes(ROWS, width * 10**6, step * 10**6)
        assert tuples(got, "id", "window_start", "s") == sorted(((k, at(p), sum(v)) for (k, p), v in want.items()), key=str)


@pytest.mark.parametrize("blocks", [Blocks(rows=15, limit=500), Blocks(rows=15, limit=4), None])
def test_sessions(spark, blocks):
    got = session_windows(
        frame(spark, ROWS), keys=["id"], ts="ts", gap="40 seconds", measures={"n": count_rows(), "hi": max_of("vc")},
        blocks=blocks,
    )
    want = []
    for key, group in by_key(ROWS).items():
        run = [group[0]]
        for r in group[1:] + [None]:
            if r is not None and us(r[2]) - us(run[-1][2]) <= 40 * 10**6:
                run.append(r)
                continue
            want.append((key, run[0][2], run[-1][2] + timedelta(seconds=40), len(run), max(q[3] for q in run)))
            run = [r]
    assert tuples(got, "id", "window_start", "window_end", "n", "hi") == sorted(want, key=str)


def test_rows_one_gap_apart_share_a_session(spark):
    rows = [(0, "a", START, 1), (1, "a", START + timedelta(seconds=5), 2), (2, "a", START + timedelta(seconds=11), 4)]
    got = session_windows(frame(spark, rows), keys=["id"], ts="ts", gap="5 seconds", measures={"s": sum_of("vc")})
    assert sorted(r["s"] for r in got.collect()) == [3, 4]


def test_sessions_stream_equals_batch(spark, folder):
    stream = feed(spark, f"{folder}/in", [*split(ROWS, 3), [sentinel()]]).withWatermark("ts", "2 seconds")
    got = appended_rows(
        streaming_session(stream, keys=["id"], ts="ts", gap="40 seconds", aggs={"n": F.count(F.lit(1))})
    )
    want = session_windows(frame(spark, ROWS), keys=["id"], ts="ts", gap="40 seconds", measures={"n": count_rows()})
    assert tuples(got, "id", "window_start", "n") == tuples(want, "id", "window_start", "n")


def test_early_results(spark):
    got = early_results(
        frame(spark, ROWS), keys=[], ts="ts", size="1 hour", order=["seq"], folds={"n": running_count()},
        blocks=Blocks(rows=20),
    )
    seen, want = Counter(), []
    for r in ROWS:
        hour = r[2].replace(minute=0, second=0)
        seen[hour] += 1
        want.append((r[0], hour, seen[hour]))
    assert tuples(got, "seq", "window_start", "n") == sorted(want, key=str)


@pytest.mark.parametrize("make", [count_rows, lambda: max_of("vc"), lambda: sum_of(F.col("vc") / 7)])
def test_panes_are_put_out_after_the_last_shuffle(spark, make):
    """Whatever the measure, nothing is copied per pane before an exchange: shuffled rows do not grow with size / slide."""
    hop = dense_hop(frame(spark, ROWS), keys=["id"], ts="ts", size="1 hour", slide="5 seconds", measures={"n": make()})
    plan = hop._jdf.queryExecution().executedPlan().toString()
    assert "sequence" in plan and plan.rindex("sequence") < plan.index("Exchange") and plan.count("Exchange") == 2


@pytest.mark.parametrize("size, slide", [(90, 35), (60, 60), (45, 30)])
def test_panes_of_any_ratio(spark, size, slide):
    want = panes(ROWS, size * 10**6, slide * 10**6)
    got = dense_hop(frame(spark, ROWS), keys=["id"], ts="ts", size=f"{size} seconds", slide=f"{slide} seconds",
                    measures={"n": count_rows(), "hi": max_of("vc"), "mean": sum_of(F.col("vc") / 7)})
    rows = {(r["id"], us(r["window_start"])): (r["n"], r["hi"], r["mean"]) for r in got.collect()}
    assert rows.keys() == want.keys()
    for k, v in want.items():
        assert rows[k][:2] == (len(v), max(v)) and rows[k][2] == pytest.approx(sum(v) / 7, rel=1e-12)


def test_panes_without_rows(spark):
    assert dense_hop(frame(spark, []), keys=["id"], ts="ts", size="1 hour", slide="1 minute", measures={"n": count_rows()}).count() == 0
