"""Patterns and timers: bounded form, a plain loop, and the stateful stream agree."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from data import START, by_key, feed, frame, sentinel, shaped, split, tuples, us
from weirstone.operators import patterns as P
from weirstone.operators.running import Blocks
from weirstone.streaming import processors as S
from weirstone.streaming.runner import appended_rows

SEC = 1_000_000
SMALL = pytest.mark.parametrize("blocks", [Blocks(rows=20), None])


def kinds(n=300, seed=3, share=0.5):
    """vc 1 = start/fail, 0 = end/success."""
    rng, at, rows = random.Random(seed), START, []
    for seq in range(n):
        at += timedelta(seconds=rng.choice([0, 1, 1, 2, 9]))
        rows.append((seq, "hot" if rng.random() < 0.5 else f"k{rng.randrange(5)}", at, int(rng.random() < share)))
    return rows


ROWS = kinds()


def streamed(spark, folder, rows, processor, out, columns):
    stream = feed(spark, f"{folder}/in", [*split(rows, 3), [sentinel()]]).withWatermark("ts", "1 second")
    shaped_rows = shaped(stream).select("id", "ts", "_seq", "_us", *columns)
    result = S.stateful(shaped_rows, keys=["id"], processor=processor, output=out, time_mode="EventTime")
    return appended_rows(result, mode="update").where("id <> '~end'")


def stamps(df, *columns):
    return df.select("id", *[F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in columns])


@SMALL
@pytest.mark.parametrize("times", [2, 3])
def test_strict_repeat(spark, blocks, times):
    got = P.strict_repeat(
        frame(spark, ROWS), keys=["id"], order=["ts", "seq"], matches=F.col("vc") == 1, times=times,
        within="5 seconds", blocks=blocks,
    )
    want = []
    for key, group in by_key(ROWS).items():
        for i in range(times - 1, len(group)):
            run = group[i - times + 1 : i + 1]
            if all(r[3] == 1 for r in run) and us(run[-1][2]) - us(run[0][2]) < 5 * SEC:
                want.append((key, run[0][2], run[-1][2]))
    assert tuples(got, "id", "first_ts", "last_ts") == sorted(want, key=str)


def test_strict_repeat_stream(spark, folder):
    out = "id string, first_us long, last_us long"
    got = streamed(
        spark, folder, ROWS, S.StrictRepeat(out, 2, 5 * SEC), out, [(F.col("vc") == 1).alias("hit")]
    )
    want = P.strict_repeat(
        frame(spark, ROWS), keys=["id"], order=["ts", "seq"], matches=F.col("vc") == 1, times=2, within="5 seconds"
    )
    assert tuples(got, "id", "first_us", "last_us") == tuples(
        stamps(want, "first_ts", "last_ts"), "id", "first_ts", "last_ts"
    )


def followed(rows, within):
    matched, late = [], []
    for key, group in by_key(rows).items():
        for i, r in enumerate(group):
            if r[3] == 1:
                end = next((q for q in group[i + 1 :] if q[3] == 0), None)
                if end and us(end[2]) - us(r[2]) < within:
                    matched.append((key, us(r[2]), us(end[2])))
                else:
                    late.append((key, us(r[2]), us(r[2]) + within))
    return sorted(matched, key=str), sorted(late, key=str)


@SMALL
def test_followed_by(spark, blocks):
    hit, miss = P.followed_by(
        frame(spark, ROWS), keys=["id"], order=["ts", "seq"], starts=F.col("vc") == 1, ends=F.col("vc") == 0,
        within="6 seconds", blocks=blocks,
    )
    matched, late = followed(ROWS, 6 * SEC)
    assert tuples(stamps(hit, "start_ts", "end_ts"), "id", "start_ts", "end_ts") == matched
    assert tuples(stamps(miss, "start_ts", "timeout_ts"), "id", "start_ts", "timeout_ts") == late


def test_followed_by_stream(spark, folder):
    out = "id string, start_us long, end_us long, tag string"
    got = streamed(
        spark, folder, ROWS, S.FollowedBy(out, 6 * SEC), out,
        [(F.col("vc") == 1).alias("starts"), (F.col("vc") == 0).alias("ends")],
    )
    matched, late = followed(ROWS, 6 * SEC)
    assert tuples(got.where("tag = 'matched'"), "id", "start_us", "end_us") == matched
    assert tuples(got.where("tag = 'timeout'"), "id", "start_us", "end_us") == late


def monitored(rows, within):
    paid, stray, unpaid = [], [], []
    for key, group in by_key(rows).items():
        for i, r in enumerate(group):
            prev = group[i - 1] if i else None
            nxt = group[i + 1] if i + 1 < len(group) else None
            if r[3] == 0:
                if prev and prev[3] == 1 and us(r[2]) - us(prev[2]) <= within:
                    paid.append((key, us(prev[2]), us(r[2])))
                else:
                    stray.append((key, us(r[2])))
            elif nxt is None or us(nxt[2]) - us(r[2]) > within:
                unpaid.append((key, us(r[2]), us(r[2]) + within))
    return [sorted(x, key=str) for x in (paid, stray, unpaid)]


@SMALL
def test_pay_monitor(spark, blocks):
    paid, stray, unpaid = P.pay_monitor(
        frame(spark, ROWS), keys=["id"], order=["ts", "seq"], creates=F.col("vc") == 1, pays=F.col("vc") == 0,
        within="6 seconds", blocks=blocks,
    )
    want = monitored(ROWS, 6 * SEC)
    assert tuples(stamps(paid, "create_ts", "pay_ts"), "id", "create_ts", "pay_ts") == want[0]
    assert tuples(stamps(stray, "pay_ts"), "id", "pay_ts") == want[1]
    assert tuples(stamps(unpaid, "create_ts", "timeout_ts"), "id", "create_ts", "timeout_ts") == want[2]


def test_pay_monitor_stream(spark, folder):
    out = "id string, create_us long, other_us long, tag string"
    got = streamed(spark, folder, ROWS, S.PayMonitor(out, 6 * SEC), out, [(F.col("vc") == 1).alias("creates")])
    want = monitored(ROWS, 6 * SEC)
    assert tuples(got.where("tag = 'paid'"), "id", "create_us", "other_us") == want[0]
    assert tuples(got.where("tag = 'no_create'"), "id", "other_us") == want[1]
    assert tuples(got.where("tag = 'no_pay'"), "id", "create_us", "other_us") == want[2]


def fail_windows(rows, within, at_least):
    want = []
    for key, group in by_key(rows).items():
        run = []
        for r in group + [None]:
            if r is not None and r[3] == 1:
                run.append(r)
                continue
            near = [q for q in run if us(q[2]) - us(run[0][2]) <= within]
            if len(near) >= at_least:
                want.append((key, us(near[0][2]), us(near[-1][2]), len(near)))
            run = []
    return sorted(want, key=str)


@SMALL
def test_fail_window(spark, blocks):
    rows = kinds(share=0.7)
    got = P.fails_in_window(
        frame(spark, rows), keys=["id"], order=["ts", "seq"], fails=F.col("vc") == 1, within="4 seconds",
        at_least=2, blocks=blocks,
    )
    got = got.select("id", F.unix_micros(F.col("first_ts").cast("timestamp")).alias("a"), F.unix_micros("last_ts").alias("b"), "fails")
    assert tuples(got, "id", "a", "b", "fails") == fail_windows(rows, 4 * SEC, 2)


def test_fail_window_stream(spark, folder):
    rows = kinds(share=0.7)
    out = "id string, first_us long, last_us long, fails long"
    got = streamed(spark, folder, rows, S.FailWindow(out, 4 * SEC, 2), out, [(F.col("vc") == 1).alias("fail")])
    assert tuples(got, "id", "first_us", "last_us", "fails") == fail_windows(rows, 4 * SEC, 2)


@SMALL
def test_fail_pairs(spark, blocks):
    got = P.fail_pairs(
        frame(spark, ROWS), keys=["id"], ts="ts", order=["seq"], fails=F.col("vc") == 1, within="2 seconds", blocks=blocks
    )
    want = [
        b[0]
        for group in by_key(ROWS).values()
        for a, b in zip(group, group[1:])
        if a[3] == b[3] == 1 and abs(us(b[2]) - us(a[2])) <= 2 * SEC
    ]
    assert tuples(got, "seq") == sorted(((s,) for s in want), key=str)


def rises(n=300, seed=5):
    rng, at, level, rows = random.Random(seed), START, 0, []
    for seq in range(n):
        at += timedelta(seconds=rng.choice([1, 2, 4]))
        level = max(0, level + rng.choice([-3, 0, 1, 2, 2, 3]))
        rows.append((seq, "hot" if rng.random() < 0.5 else f"k{rng.randrange(4)}", at, level))
    return rows


def alerts(rows, hold, strict, rearm):
    want = []
    for key, group in by_key(rows).items():
        since, fired, last = None, False, None
        for r in group + [(0, key, START + timedelta(days=500), None)]:
            now = us(r[2])
            if since is not None and not fired and since + hold < now:
                want.append((key, since, since + hold))
                since, fired = (None, False) if rearm else (since, True)
            if r[3] is None:
                break
            fell = last is not None and (r[3] <= last if strict else r[3] < last)
            last = r[3]
            if fell:
                since, fired = None, False
            elif since is None:
                since, fired = now, False
    return sorted(want, key=str)


@SMALL
@pytest.mark.parametrize("strict", [False, True])
def test_no_drop(spark, blocks, strict):
    rows = rises()
    got = P.no_drop_alerts(
        frame(spark, rows), keys=["id"], order=["ts", "seq"], value="vc", hold="6 seconds", strict=strict, blocks=blocks
    )
    want = alerts(rows, 6 * SEC, strict, rearm=False)
    assert want and tuples(stamps(got, "run_start", "alert_at"), "id", "run_start", "alert_at") == want


@SMALL
@pytest.mark.parametrize("hold", [1, 3, 6, 20])
def test_no_drop_armed_again(spark, blocks, hold):
    rows = [(s, None if k == "k2" else k, t, v) for s, k, t, v in rises()]
    got = P.no_drop_alerts(
        frame(spark, rows).repartition(3), keys=["id"], order=["ts", "seq"], value="vc", hold=f"{hold} seconds", rearm=True, blocks=blocks
    )
    want = alerts(rows, hold * SEC, False, rearm=True)
    assert tuples(stamps(got, "run_start", "alert_at"), "id", "run_start", "alert_at") == want
    assert hold > 6 or len(want) > len(alerts(rows, hold * SEC, False, rearm=False)) > 0


@pytest.mark.parametrize("rearm", [False, True])
def test_no_drop_stream(spark, folder, rearm):
    rows = rises()
    out = "id string, run_start long, alert_at long"
    got = streamed(spark, folder, rows, S.NoDropAlert(out, "vc", 6 * SEC, rearm=rearm), out, ["vc"])
    assert tuples(got, "id", "run_start", "alert_at") == alerts(rows, 6 * SEC, False, rearm)
