"""Joins, control switch, watermarks and late data."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from data import START, feed, frame, sentinel, shaped, skewed, split, tuples, us
from weirstone.operators import joins as J
from weirstone.operators.late import classify_lateness, split_late, watermark_trace
from weirstone.operators.running import Blocks
from weirstone.plans.hot_lists import hot_urls, stream_hot_items
from weirstone.streaming import processors as S
from weirstone.streaming.runner import appended_rows

SEC = 1_000_000


def sides(n=150, seed=11):
    rng = random.Random(seed)

    def one(first):
        return [
            (first + i, "hot" if rng.random() < 0.4 else f"t{rng.randrange(20)}", START + timedelta(seconds=rng.randrange(900)))
            for i in range(n)
        ]

    return one(0), one(1000)


LEFT, RIGHT = sides()
PAIRS = sorted(
    ((a[1], a[0], b[0]) for a in LEFT for b in RIGHT if a[1] == b[1] and -5 * SEC <= us(b[2]) - us(a[2]) <= 10 * SEC), key=str
)


def left(spark):
    return spark.createDataFrame(LEFT, "lid long, tx string, lts timestamp")


def right(spark):
    return spark.createDataFrame(RIGHT, "rid long, tx string, rts timestamp")


@pytest.mark.parametrize("bucketed", [True, False])
def test_interval_join(spark, bucketed):
    got = J.interval_join(
        left(spark), right(spark), keys=["tx"], left_ts="lts", right_ts="rts", lower="-5 seconds", upper="10 seconds",
        bucketed=bucketed,
    )
    assert PAIRS and tuples(got, "tx", "lid", "rid") == PAIRS


def test_interval_bounds_are_inclusive(spark):
    a = spark.createDataFrame([(1, "x", START)], "lid long, tx string, lts timestamp")
    b = spark.createDataFrame(
        [(i, "x", START + timedelta(microseconds=d)) for i, d in enumerate([-5 * SEC - 1, -5 * SEC, 10 * SEC, 10 * SEC + 1])],
        "rid long, tx string, rts timestamp",
    )
    got = J.interval_join(a, b, keys=["tx"], left_ts="lts", right_ts="rts", lower="-5 seconds", upper="10 seconds")
    assert tuples(got, "rid") == [(1,), (2,)]


def test_reconcile(spark):
    pairs, no_right, no_left = J.reconcile(
        left(spark), right(spark), keys=["tx"], left_id="lid", right_id="rid", left_ts="lts", right_ts="rts",
        lower="-5 seconds", upper="10 seconds",
    )
    assert tuples(pairs, "tx", "lid", "rid") == PAIRS
    assert tuples(no_right, "lid") == sorted(((r[0],) for r in LEFT if r[0] not in {p[1] for p in PAIRS}), key=str)
    assert tuples(no_left, "rid") == sorted(((r[0],) for r in RIGHT if r[0] not in {p[2] for p in PAIRS}), key=str)


def test_reconcile_stream(spark, folder):
    tagged = [(r[0], r[1], r[2], 0) for r in LEFT] + [(r[0], r[1], r[2], 1) for r in RIGHT]
    tagged.sort(key=lambda r: r[2])
    stream = feed(spark, f"{folder}/in", [*split(tagged, 3), [sentinel()]]).withWatermark("ts", "1 second")
    rows = shaped(stream).select("id", "ts", "_seq", "_us", F.when(F.col("vc") == 0, "left").otherwise("right").alias("side"))
    out = "id string, left_us long, right_us long, tag string"
    got = appended_rows(
        S.stateful(rows, keys=["id"], processor=S.Reconcile(out, -5 * SEC, 10 * SEC), output=out, time_mode="EventTime"),
        mode="update",
    ).where("id <> '~end'")
    times = {r[0]: us(r[2]) for r in LEFT + RIGHT}
    assert tuples(got.where("tag = 'matched'"), "id", "left_us", "right_us") == sorted(
        ((k, times[a], times[b]) for k, a, b in PAIRS), key=str
    )
    lonely = sorted(((r[1], us(r[2])) for r in LEFT if r[0] not in {p[1] for p in PAIRS}), key=str)
    assert tuples(got.where("tag = 'no_right'"), "id", "left_us") == lonely
    lonely = sorted(((r[1], us(r[2])) for r in RIGHT if r[0] not in {p[2] for p in PAIRS}), key=str)
    assert tuples(got.where("tag = 'no_left'"), "id", "right_us") == lonely


def test_interval_join_stream(spark, folder):
    a = sorted(((r[0], r[1], r[2], 0) for r in LEFT), key=lambda r: r[2])
    b = sorted(((r[0], r[1], r[2], 0) for r in RIGHT), key=lambda r: r[2])
    ls = feed(spark, f"{folder}/l", split(a, 2)).select(F.col("seq").alias("lid"), F.col("id").alias("tx"), F.col("ts").alias("lts"))
    rs = feed(spark, f"{folder}/r", split(b, 2)).select(F.col("seq").alias("rid"), F.col("id").alias("tx"), F.col("ts").alias("rts"))
    got = J.interval_join(
        ls.withWatermark("lts", "20 minutes"), rs.withWatermark("rts", "20 minutes"), keys=["tx"], left_ts="lts",
        right_ts="rts", lower="-5 seconds", upper="10 seconds",
    )
    assert tuples(appended_rows(got.select("tx", "lid", "rid")), "tx", "lid", "rid") == PAIRS


@pytest.mark.parametrize("blocks", [Blocks(rows=20), None])
def test_control_switch(spark, blocks):
    rows = skewed(300)
    df = frame(spark, rows)
    control = df.where("vc < 6").select("seq", F.col("vc").cast("string").alias("v"))
    got = J.control_switch(df.where("vc >= 6"), control, seq="seq", value="v", blocks=blocks)
    now, want = None, []
    for r in rows:
        if r[3] < 6:
            now = str(r[3])
        else:
            want.append((r[0], r[1], now))
    assert tuples(got, "seq", "id", "switch") == sorted(want, key=str)


ROWS = skewed(400, disorder=400)


def brute_lateness(rows, size, slide, delay, lateness):
    seen, out = None, {}
    for r in rows:
        wm = None if seen is None else seen - delay
        end = us(r[2]) // slide * slide + size
        out[r[0]] = (
            "on_time" if wm is None or end > wm else "late" if end + lateness > wm else "too_late", wm
        )
        seen = us(r[2]) if seen is None else max(seen, us(r[2]))
    return out


@pytest.mark.parametrize("blocks", [Blocks(rows=20), None])
def test_lateness(spark, blocks):
    got = classify_lateness(
        frame(spark, ROWS), ts="ts", order=["seq"], size="5 seconds", delay="2 seconds", lateness="60 seconds", blocks=blocks
    )
    want = brute_lateness(ROWS, 5 * SEC, 5 * SEC, 2 * SEC, 60 * SEC)
    assert {v[0] for v in want.values()} == {"on_time", "late", "too_late"}
    assert tuples(got, "seq", "lateness") == sorted(((k, v[0]) for k, v in want.items()), key=str)
    kept, side = split_late(got)
    assert kept.count() + side.count() == len(ROWS)


def test_watermark_trace(spark):
    got = watermark_trace(frame(spark, ROWS), ts="ts", order=["seq"], delay="2 seconds", blocks=Blocks(rows=30))
    seen, want = None, []
    for r in ROWS:
        seen = r[2] if seen is None else max(seen, r[2])
        want.append((r[0], seen - timedelta(seconds=2)))
    assert tuples(got, "seq", "watermark") == sorted(want, key=str)


def test_hot_urls_skip_closed_windows(spark):
    size, slide, delay, late = 120 * SEC, 30 * SEC, 2 * SEC, 60 * SEC
    got = hot_urls(
        frame(spark, ROWS), url="id", ts="ts", order=["seq"], size="2 minutes", slide="30 seconds", delay="2 seconds",
        lateness="1 minute", n=2,
    )
    judged, counts = brute_lateness(ROWS, size, slide, delay, late), {}
    for r in ROWS:
        wm = judged[r[0]][1]
        start = us(r[2]) // slide * slide
        while start > us(r[2]) - size:
            if wm is None or start + size + late > wm:
                counts.setdefault(start, {}).setdefault(r[1], 0)
                counts[start][r[1]] += 1
            start -= slide
    want = []
    for start, per in counts.items():
        best = sorted(per.items(), key=lambda p: (-p[1], p[0]))[:2]
        want += [(start + size, k, n, i + 1) for i, (k, n) in enumerate(best)]
    got = got.select(F.unix_micros(F.col("window_end").cast("timestamp")).alias("e"), "id", "ct", "rk")
    assert tuples(got, "e", "id", "ct", "rk") == sorted(want, key=str)


def test_hot_items_stream(spark, folder):
    rows = skewed(300)
    stream = feed(spark, f"{folder}/in", [*split(rows, 3), [sentinel()]])
    target = f"{folder}/top"
    stream_hot_items(
        stream, item="id", ts="ts", size="10 minutes", slide="5 minutes", n=3, delay="1 second",
        write=lambda batch, i: batch.write.mode("overwrite").parquet(f"{target}/b={i}"),
    )
    got = spark.read.parquet(target)
    from weirstone.plans.hot_lists import hot_items

    want = hot_items(frame(spark, rows), item="id", ts="ts", size="10 minutes", slide="5 minutes", n=3)
    assert tuples(got.withColumn("window_end", F.col("window_end").cast("timestamp_ntz")), "window_end", "id", "ct", "rk") == tuples(
        want, "window_end", "id", "ct", "rk"
    )
