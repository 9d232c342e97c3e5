"""Firings of late windows and re-ranked lists against a row-by-row model."""

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from data import START, frame, skewed, us
from weirstone.operators.firings import hot_versions, late_firings
from weirstone.operators.running import Blocks, running_count, running_max, running_sum
from weirstone.streaming import feed as feeds
from weirstone.streaming.feed import Feed
from weirstone.streaming.late import LateFirings
from weirstone.streaming.runner import drain
from weirstone.streaming.state import Versions

ROWS = skewed(900, disorder=2500)
SIZES = {"size": "10 minutes", "delay": "5 minutes", "lateness": "20 minutes"}
SIZE, DELAY, LATENESS = 600_000_000, 300_000_000, 1_200_000_000


def folds():
    return {"ct": running_count(), "total": running_sum(F.col("vc")), "top": running_max(F.col("vc"))}


def model(rows, by):
    """Windows fire when the watermark passes them, and again at each late row."""
    held, out, high = {}, {}, None
    for seq, key, ts, vc in sorted(rows):
        wm = None if high is None else high - DELAY
        start = us(ts) - us(ts) % SIZE
        if wm is None or start + SIZE + LATENESS > wm:
            window = held.setdefault((by(key), start), [])
            window.append(vc)
            fired = out.setdefault((by(key), start), [])
            if wm is not None and start + SIZE <= wm:
                if not fired and len(window) > 1:
                    fired.append(None)  # in time, before
                    old = window[:-1]
                    fired[0] = (len(old), sum(old), max(old))
                fired.append((len(window), sum(window), max(window)))
        high = us(ts) if high is None else max(high, us(ts))
    for k, window in held.items():
        if not out[k]:
            out[k].append((len(window), sum(window), max(window)))
    return sorted((k, s, i, *v) for (k, s), values in out.items() for i, v in enumerate(values, 1))


def found(df):
    return sorted((r["id"], us(r["window_start"]), r["firing"], r["ct"], r["total"], r["top"]) for r in df.collect())


WANT = model(ROWS, lambda k: k)


def test_the_model_has_late_rows():
    assert max(r[2] for r in WANT) > 5 and len({r[:2] for r in WANT if r[2] > 1}) > 20


@pytest.mark.parametrize("rows", [1 << 20, 40])
def test_firings(spark, rows):
    df = frame(spark, ROWS).repartition(5)
    assert found(late_firings(df, keys=["id"], ts="ts", order=["seq"], folds=folds(), blocks=Blocks(rows=rows), **SIZES)) == WANT


@pytest.mark.parametrize("cuts", [[], [300, 301, 600], list(range(60, 900, 60))])
def test_stream_firings_do_not_depend_on_batches(spark, folder, cuts):
    rows, out = sorted(ROWS), []
    job = LateFirings(spark, frame(spark, rows[:1]), keys=["id"], ts="ts", order=["seq"], folds=folds(), write=lambda df, i: out.append(df.collect()), **SIZES)
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        job(frame(spark, rows[a:b]), i)
    job.flush(spark)
    got = sorted((r["id"], us(r["window_start"]), r["firing"], r["ct"], r["total"], r["top"]) for part in out for r in part)
    assert got == WANT


def test_a_batch_again_changes_nothing(spark):
    rows, out = sorted(ROWS), {}

    def write(df, i):
        out[i] = df.collect()

    job = LateFirings(spark, frame(spark, rows[:1]), keys=["id"], ts="ts", order=["seq"], folds=folds(), write=write, **SIZES)
    for i, part in enumerate((rows[:400], rows[400:700], rows[700:])):
        job(frame(spark, part), i)
        job(frame(spark, part), i)
    job.flush(spark)
    got = sorted((r["id"], us(r["window_start"]), r["firing"], r["ct"], r["total"], r["top"]) for part in out.values() for r in part)
    assert got == WANT


def test_another_object_goes_on_from_the_same_state(spark, folder):
    rows, out = sorted(ROWS), []
    for i, part in enumerate((rows[:400], rows[400:])):
        job = LateFirings(spark, frame(spark, rows[:1]), keys=["id"], ts="ts", order=["seq"], folds=folds(), write=lambda df, _: out.extend(df.collect()), path=folder, **SIZES)
        job(frame(spark, part), i)
    job.flush(spark)
    assert sorted((r["id"], us(r["window_start"]), r["firing"], r["ct"], r["total"], r["top"]) for r in out) == WANT


def test_state_forgets_closed_windows(spark):
    rows = sorted(ROWS)
    job = LateFirings(spark, frame(spark, rows[:1]), keys=["id"], ts="ts", order=["seq"], folds=folds(), write=lambda df, i: df.count(), **SIZES)
    job(frame(spark, rows[:600]), 0)
    job(frame(spark, rows[600:]), 1)
    high = max(us(r[2]) for r in rows) - DELAY - LATENESS - SIZE
    held = job.held.before(spark, 2)
    assert 0 < held.count() == held.where(F.col("_start") > high).count()


def test_null_keys_and_no_rows(spark):
    rows = [(s, None if k == "hot" else k, t, v) for s, k, t, v in ROWS]
    got = found_null(late_firings(frame(spark, rows), keys=["id"], ts="ts", order=["seq"], folds=folds(), **SIZES))
    assert got == sorted(("hot" if r[0] == "hot" else r[0], *r[1:]) for r in WANT)
    assert late_firings(frame(spark, []), keys=["id"], ts="ts", order=["seq"], folds=folds(), **SIZES).count() == 0


def found_null(df):
    return sorted((r["id"] or "hot", us(r["window_start"]), r["firing"], r["ct"], r["total"], r["top"]) for r in df.collect())


def ranked_model(rows, size, slide, n):
    counts, base, out, versions, high = {}, {}, [], {}, None

    def top(held):
        return sorted(((-c, k) for k, c in held.items()))[:n]

    late = []
    for seq, key, ts, _ in sorted(rows):
        wm = None if high is None else high - DELAY
        at = us(ts)
        start = at - at % slide
        while start > at - size:
            if wm is None or start + size > wm:
                held = base.setdefault(start, {})
                held[key] = held.get(key, 0) + 1
            elif start + size + LATENESS > wm:
                late.append((start, key))
            start -= slide
        high = at if high is None else max(high, at)
    for start, held in base.items():
        versions[start] = 1
        out += [(start, 1, i, k, -c) for i, (c, k) in enumerate(top(held), 1)]
    counts = {s: dict(h) for s, h in base.items()}
    for start, key in late:
        held = counts.setdefault(start, {})
        held[key] = held.get(key, 0) + 1
        versions[start] = versions.get(start, 0) + 1
        out += [(start, versions[start], i, k, -c) for i, (c, k) in enumerate(top(held), 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 16, 7, 1])
@pytest.mark.parametrize("n", [1, 3])
def test_lists_ranked_anew(spark, n, block):
    df = frame(spark, ROWS).repartition(4)
    got = hot_versions(df, item="id", ts="ts", order=["seq"], size="10 minutes", slide="5 minutes", delay="5 minutes", lateness="20 minutes", n=n,
                       blocks=Blocks(rows=100), rank_block=block)
    rows = sorted((us(r["window_end"]) - SIZE, r["version"], r["rk"], r["id"], r["ct"]) for r in got.collect())
    assert rows == ranked_model(ROWS, SIZE, SIZE // 2, n)


def test_versions(spark):
    state = Versions(spark, "n long")
    assert state.before(spark, 0).count() == 0
    for i in range(7):
        total = sum(r["n"] for r in state.before(spark, i).collect())
        for _ in range(2):  # a repeated batch
            assert sum(r["n"] for r in state.before(spark, i).collect()) == total
            state.write(spark.createDataFrame([(total + i,)], "n long"), i)
    assert [r["n"] for r in state.before(spark, 7).collect()] == [21]
    assert len(os.listdir(state.path)) == 3


@pytest.mark.parametrize("slice_rows", [400, 50])
def test_feed_reads_its_table_a_fixed_number_of_times(spark, folder, monkeypatch, slice_rows):
    rows = [(i * 7 % 1000, f"k{i % 3}") for i in range(1000)]
    spark.createDataFrame(rows, "seq long, k string").repartition(6).write.parquet(f"{folder}/t.parquet")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    plain = spark.read.parquet(f"{folder}/t.parquet")
    monkeypatch.setattr(feeds, "table", lambda *_: plain)
    monkeypatch.setattr(feeds, "LISTED", 3)
    feed = Feed(spark, folder, "t", "seq", slice_rows=slice_rows, shape=lambda df: df.mapInArrow(counted, df.schema))
    out = []
    drain(feed.stream, lambda df, i: out.append([r["seq"] for r in df.collect()]), mode="append", feed=feed)
    # Once for the bounds of the slices, once for the slices.
    assert read.value <= 2 * len(rows)
    assert len(out) >= 1000 // slice_rows // 2 and sorted(x for part in out for x in part) == list(range(1000))
    assert all(max(a) < min(b) for a, b in zip(out, out[1:]))


def test_feed_of_one_slice(spark, folder):
    spark.createDataFrame([(3, START), (1, START + timedelta(days=1))], "seq long, ts timestamp_ntz").coalesce(1).write.parquet(f"{folder}/x")
    part = next(n for n in os.listdir(f"{folder}/x") if n.startswith("part"))
    os.makedirs(f"{folder}/y")
    os.link(f"{folder}/x/{part}", f"{folder}/y/t.parquet")
    plain = spark.read.parquet(f"{folder}/y/t.parquet")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(feeds, "table", lambda *_: plain)
        feed = Feed(spark, f"{folder}/y", "t", "seq", end="ts", marks={"seq": -1})
    out = []
    drain(feed.stream, lambda df, i: out.append(sorted(r["seq"] for r in df.collect())), mode="append", feed=feed)
    assert out == [[1, 3], [-1]]
