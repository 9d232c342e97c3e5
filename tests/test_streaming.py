"""Stateful processors by arrival, timers, checkpoints and restarts."""

import os
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from data import START, add_batch, by_key, feed, frame, sentinel, shaped, skewed, split, tuples
from weirstone.operators import rolling as R
from weirstone.operators.over import over_unbounded
from weirstone.operators.rows import branch, tag_split, write_branches
from weirstone.operators.running import running_count
from weirstone.plans.ads import judge_clicks
from weirstone.streaming import processors as S
from weirstone.streaming.runner import appended_rows, drain, latest_rows

ROWS = skewed(240)


def arrivals(spark, folder, columns=("vc",)):
    stream = feed(spark, f"{folder}/in", split(ROWS, 3))
    return shaped(stream).select("id", "_seq", *columns)


def run(rows, processor, out, **kwargs):
    return appended_rows(S.stateful(rows, keys=["id"], processor=processor, output=out, **kwargs), mode="update")


def test_reduce(spark, folder):
    """First id kept, latest time, largest value: state carries over micro-batches."""
    out = "id string, seq long, first_seq long, hi long"
    step = S.Reduce(
        out, "first_seq long, hi long",
        start=lambda r: (r["_seq"], r["vc"]),
        fold=lambda acc, r: (acc[0], max(acc[1], r["vc"])),
        emit=lambda acc, r: (r["_seq"], *acc),
    )
    got = run(arrivals(spark, folder), step, out)
    want = []
    for key, group in by_key(ROWS).items():
        for i, r in enumerate(group):
            want.append((key, r[0], group[0][0], max(q[3] for q in group[: i + 1])))
    assert tuples(got, "id", "seq", "first_seq", "hi") == sorted(want, key=str)


def test_changelog(spark, folder):
    out = "id string, step long, added boolean, ct long"
    got = run(arrivals(spark, folder), S.CountChangelog(out), out)
    want = R.changelog_count(frame(spark, ROWS), keys=["id"], order=["seq"])
    assert tuples(got, "id", "step", "added", "ct") == tuples(want, "id", "step", "added", "ct")


def test_top_list(spark, folder):
    out = "id string, seq long, top array<long>"
    got = run(arrivals(spark, folder), S.TopList(out, "vc"), out)
    want = R.running_top(frame(spark, ROWS), keys=["id"], order=["seq"], value="vc")
    assert tuples(got, "id", "seq", "top") == tuples(want, "id", "seq", "top")


@pytest.mark.parametrize("slide,full", [(None, False), (2, False), (2, True)])
def test_count_window(spark, folder, slide, full):
    out = "id string, n long, s long"
    got = run(arrivals(spark, folder), S.CountWindow(out, "vc", 5, slide, full), out)
    want = []
    for key, group in by_key(ROWS).items():
        vals = [r[3] for r in group]
        step = slide or 5
        want += [
            (key, n, sum(vals[max(0, n - 5) : n])) for n in range(step, len(vals) + 1, step) if n >= 5 or not full
        ]
    assert tuples(got, "id", "n", "s") == sorted(want, key=str)


def test_jump_and_first_seen(spark, folder):
    out = "id string, seq long, before long, now long"
    got = run(arrivals(spark, folder), S.JumpAlert(out, "vc", 10), out)
    seen, want = {}, []
    for r in ROWS:
        if r[1] in seen and abs(r[3] - seen[r[1]]) > 10:
            want.append((r[1], r[0], seen[r[1]], r[3]))
        seen[r[1]] = r[3]
    assert tuples(got, "id", "seq", "before", "now") == sorted(want, key=str)
    out = "id string, seq long, v long"
    got = run(arrivals(spark, f"{folder}/b"), S.FirstSeen(out, "vc"), out)
    first = R.first_per_key(frame(spark, ROWS), keys=["id", "vc"], order=["seq"])
    assert tuples(got, "id", "seq", "v") == tuples(first, "id", "seq", "vc")


def test_daily_limit_clears_at_local_midnight(spark, folder):
    rows = [(i, "a", START + timedelta(hours=i), 0) for i in range(60)]
    stream = feed(spark, f"{folder}/in", split(rows, 6)).withWatermark("ts", "1 second")
    out = "id string, seq long, tag string"
    got = appended_rows(
        S.stateful(
            shaped(stream).select("id", "ts", "_seq", "_us"), keys=["id"], processor=S.DailyLimit(out, 4, 8), output=out,
            time_mode="EventTime",
        ),
        mode="update",
    )
    clicks = frame(spark, rows).withColumn("ad", F.lit(1))
    want = judge_clicks(clicks, user="id", ad="ad", ts="ts", order=["seq"], limit=4).where("verdict <> 'drop'")
    assert tuples(got, "seq", "tag") == tuples(want, "seq", "verdict")


def test_event_time_over(spark, folder):
    rows = [(i, r[1], r[2], r[3]) for i, r in enumerate(sorted(ROWS, key=lambda r: r[2]))]
    stream = feed(spark, f"{folder}/in", [*split(rows, 3), [sentinel()]]).withWatermark("ts", "1 hour")
    out = "id string, seq long, ct long"
    got = appended_rows(
        S.stateful(
            shaped(stream).select("id", "ts", "_seq", "_us", F.col("vc").alias("payload")), keys=["id"],
            processor=S.RangeCount(out), output=out, time_mode="EventTime",
        ),
        mode="update",
    ).where("id <> '~end'")
    want = over_unbounded(frame(spark, rows), keys=["id"], order=["ts"], folds={"ct": running_count()})
    assert tuples(got, "id", "seq", "ct") == tuples(want, "id", "seq", "ct")


def test_repeating_timer(spark, folder):
    """A processing-time timer fires again after it re-registers itself."""
    stream = feed(spark, f"{folder}/in", [ROWS[:20]])
    out = "id string, fires long"
    target = f"{folder}/out"
    query = (
        S.stateful(
            shaped(stream).select("id", "_seq"), keys=["id"], processor=S.RepeatingTimer(out, 300), output=out,
            time_mode="ProcessingTime",
        )
        .writeStream.foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{target}/b={i}"))
        .outputMode("update")
        .option("checkpointLocation", f"{folder}/cp")
        .trigger(processingTime="300 milliseconds")
        .start()
    )
    try:
        deadline, fired = time.time() + 60, 0
        while time.time() < deadline and fired < 2:
            time.sleep(1)
            assert query.exception() is None
            if os.path.isdir(target) and any(n.startswith("b=") for n in os.listdir(target)):
                fired = spark.read.schema(out).parquet(target).agg(F.max("fires")).first()[0] or 0
    finally:
        query.stop()
    assert fired >= 2


def test_counts_survive_a_restart(spark, folder):
    """Stop after two batches, go on from the checkpoint: each row counts once."""
    parts = split(ROWS, 4)
    source, cp, log = f"{folder}/in", f"{folder}/cp", f"{folder}/log"

    def total():
        stream = spark.readStream.schema("seq long, id string, ts timestamp, vc long").parquet(source)
        return latest_rows(stream.groupBy("id").agg(F.count(F.lit(1)).alias("n")), keys=["id"], checkpoint=cp, path=log)

    feed(spark, source, parts[:2])
    first = total().agg(F.sum("n")).first()[0]
    for i in (2, 3):
        add_batch(spark, source, i, parts[i])
    second = total()
    assert first == len(parts[0]) + len(parts[1])
    assert tuples(second, "id", "n") == sorted(((k, len(g)) for k, g in by_key(ROWS).items()), key=str)
    assert tuples(total(), "id", "n") == tuples(second, "id", "n")  # nothing new: nothing changes


def test_stateful_restart(spark, folder):
    parts = split(ROWS, 2)
    source, out = f"{folder}/in", "id string, step long, added boolean, ct long"

    def log():
        stream = spark.readStream.schema("seq long, id string, ts timestamp, vc long").parquet(source)
        rows = S.stateful(shaped(stream).select("id", "_seq"), keys=["id"], processor=S.CountChangelog(out), output=out)
        return appended_rows(rows, mode="update", checkpoint=f"{folder}/cp", path=f"{folder}/rows")

    feed(spark, source, parts[:1])
    log()
    add_batch(spark, source, 1, parts[1])
    want = R.changelog_count(frame(spark, ROWS), keys=["id"], order=["seq"])
    assert tuples(log(), "id", "step", "added", "ct") == tuples(want, "id", "step", "added", "ct")


def test_side_outputs_in_one_pass(spark, folder):
    stream = tag_split(feed(spark, f"{folder}/in", split(ROWS, 2)), F.col("vc") >= 30)

    def sink(name):
        return lambda df, i: df.write.mode("overwrite").parquet(f"{folder}/{name}/b={i}")

    drain(stream, write_branches({"main": sink("main"), "side": sink("side")}, {"side": ["id", "vc"]}), mode="append")
    main, side = spark.read.parquet(f"{folder}/main"), spark.read.parquet(f"{folder}/side")
    assert tuples(main, "seq") == sorted(((r[0],) for r in ROWS if r[3] >= 30), key=str)
    assert side.drop("b").columns == ["id", "vc"] and side.count() == sum(r[3] < 30 for r in ROWS)
    assert branch(tag_split(frame(spark, ROWS), F.col("vc") >= 30), "main").count() == main.count()


def test_watermark_drops_only_after_the_delay(spark, folder):
    """The slower of two inputs holds the watermark back."""
    early = [(0, "a", START, 1)]
    ahead = [(1, "a", START + timedelta(hours=1), 1)]
    late = [(2, "a", START + timedelta(minutes=1), 1)]
    one = feed(spark, f"{folder}/one", [early, late]).withWatermark("ts", "5 minutes")
    two = feed(spark, f"{folder}/two", [ahead, [(3, "b", START + timedelta(hours=1), 1)]]).withWatermark("ts", "5 minutes")
    counts = one.unionByName(two).groupBy(F.window("ts", "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    got = latest_rows(counts, keys=["w"])
    assert got.agg(F.sum("n")).first()[0] == 4


def test_left_join_retracts_the_padded_row(spark, folder):
    """Tagged rows (vc 0 = left, 1 = right) over three micro-batches."""
    plan = [[(0, "a", 0), (1, "b", 0)], [(2, "a", 1), (3, "c", 1)], [(4, "a", 1), (5, "c", 0), (6, "b", 0)]]
    batches = [[(seq, key, START, side) for seq, key, side in part] for part in plan]
    stream = shaped(feed(spark, f"{folder}/in", batches)).select(
        "id", "_seq", F.when(F.col("vc") == 0, "left").otherwise("right").alias("side"), F.col("seq").cast("string").alias("value")
    )
    out = "id string, added boolean, left_value string, right_value string"
    got = run(stream, S.LeftJoinChangelog(out), out)
    assert tuples(got, "id", "added", "left_value", "right_value") == sorted(
        [
            ("a", True, "0", None), ("b", True, "1", None), ("a", False, "0", None), ("a", True, "0", "2"),
            ("a", True, "0", "4"), ("c", True, "5", "3"), ("b", True, "6", None),
        ],
        key=str,
    )


def test_late_rows_refire_or_go_to_the_side(spark, folder):
    from data import us
    from weirstone.operators.windows import count_rows, sum_of
    from weirstone.streaming.late import LateSplit, RefiringWindows

    rows = skewed(300, disorder=300)
    parts = split(rows, 6)
    windows = RefiringWindows(
        f"{folder}/win", keys=["id"], ts="ts", size="5 seconds", measures={"n": count_rows(), "s": sum_of("vc")}
    )
    job = LateSplit(
        f"{folder}/marks", ts="ts", size="5 seconds", delay="2 seconds", lateness="60 seconds", main=windows.write,
        side=lambda b, i: b.write.mode("overwrite").parquet(f"{folder}/side/b={i}"),
    )
    drain(feed(spark, f"{folder}/in", parts), job, mode="append")
    seen, late, kept = None, [], {}
    for part in parts:
        wm = None if seen is None else seen - 2_000_000
        for r in part:
            start = us(r[2]) // 5_000_000 * 5_000_000
            if wm is not None and start + 65_000_000 <= wm:
                late.append((r[0],))
            else:
                n, s = kept.get((r[1], start), (0, 0))
                kept[r[1], start] = (n + 1, s + r[3])
        seen = max([us(r[2]) for r in part] + ([seen] if seen is not None else []))
    got = windows.read(spark).select("id", F.unix_micros(F.col("window_start").cast("timestamp")).alias("w"), "n", "s")
    assert late and tuples(spark.read.parquet(f"{folder}/side"), "seq") == sorted(late, key=str)
    assert tuples(got, "id", "w", "n", "s") == sorted(((k, w, n, s) for (k, w), (n, s) in kept.items()), key=str)
