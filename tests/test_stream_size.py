"""What a stream costs besides its rows: state partitions, micro-batches, state calls per key."""

import os

import pytest
from pyspark.sql import functions as F

import oracle
from data import by_key, skewed, split
from data import feed as batches_of
from test_state_calls import DAY, SEC, Handle, batches, rows
from weirstone.streaming import feed as feeds
from weirstone.streaming import processors as S
from weirstone.streaming import runner
from weirstone.streaming.feed import Feed

import __spark_entry__ as entry_point

TABLES = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(TABLES), reason="tables not present")


@pytest.fixture
def checkpoints(spark, monkeypatch, tmp_path):
    """Where the queries of a test leave their checkpoints."""
    made = []

    def scratch(_, label):
        made.append(str(tmp_path / f"{label}-{len(made)}"))
        return made[-1]

    monkeypatch.setattr(runner, "scratch", scratch)
    return lambda: [p for p in made if os.path.isdir(f"{p}/commits")]


def states(checkpoint):
    return {n for n in os.listdir(f"{checkpoint}/state/0") if n.isdigit()}


def commits(checkpoint):
    return len([n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()])


@tables
@pytest.mark.parametrize("name", ["stream_interval_join", "stream_count_slide", "stream_daily_limit"])
def test_state_has_no_more_partitions_than_tasks_run(spark, checkpoints, name):
    """A query over 60 shuffle partitions keeps its state in as many as the session has cores."""
    with runner.settings(spark, spark_sql_shuffle_partitions="60"):
        got = entry_point.queries()[name](spark, TABLES)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "60"
    assert oracle.differences(got, oracle.connect(TABLES), entry_point.oracle_sql()[name]) == []
    (made,) = checkpoints()
    assert len(states(made)) == max(spark.sparkContext.defaultParallelism, runner.LEAST_PARTITIONS)


def test_few_shuffle_partitions_stay(spark):
    with runner.settings(spark, spark_sql_shuffle_partitions="2"):
        assert runner.state_partitions(spark) == 2


@tables
def test_one_micro_batch_a_slice(spark, checkpoints, monkeypatch):
    """Four slices and the end take a micro-batch each, and one without rows closes the last."""
    monkeypatch.setattr(feeds, "SLICE_ROWS", 250)
    got = entry_point.queries()["stream_no_drop"](spark, TABLES)
    assert oracle.differences(got, oracle.connect(TABLES), entry_point.oracle_sql()["stream_no_drop"]) == []
    (made,) = checkpoints()
    assert commits(made) == 6


@tables
def test_feed_tells_its_last_slice(spark):
    for end, slices in ((None, 4), ("ts", 5)):
        source = Feed(spark, TABLES, "events", "event_id", 250, end=end)
        told = []
        while source.advance():
            told.append(source.ended)
        assert told == [False] * (slices - 1) + [True] and not source.advance()


PROCESSORS = {
    "no_drop": lambda: S.NoDropAlert("k string, a long, b long", "vc", 6 * SEC, rearm=False),
    "no_drop_rearm": lambda: S.NoDropAlert("k string, a long, b long", "vc", 3 * SEC),
    "followed_by": lambda: S.FollowedBy("k string, a long, b long, tag string", 6 * SEC),
    "pay_monitor": lambda: S.PayMonitor("k string, a long, b long, tag string", 6 * SEC),
    "strict_repeat": lambda: S.StrictRepeat("k string, a long, b long", 2, 5 * SEC),
    "reconcile": lambda: S.Reconcile("k string, a long, b long, tag string", -3 * SEC, 6 * SEC),
    "range_count": lambda: S.RangeCount("k string, seq long, ct long"),
    "daily_limit": lambda: S.DailyLimit("k string, seq long, tag string", 3, 8),
}


@pytest.mark.parametrize("name", PROCESSORS)
def test_a_key_reads_and_writes_its_state_once(name):
    """Three or four calls for a key's rows of a micro-batch, three for its timer, however many rows."""
    given = list(rows(2000, DAY // 50 if name == "daily_limit" else 4 * SEC))
    out, calls, timers = batches(PROCESSORS[name](), [given[i : i + 200] for i in range(0, 2000, 200)])
    assert out and max(calls) <= 7 and timers <= 1


@pytest.mark.parametrize("name", PROCESSORS)
def test_long_buffers_go_to_a_list(monkeypatch, name):
    given = list(rows(600, DAY // 50 if name == "daily_limit" else 4 * SEC))
    parts = [given[i : i + 60] for i in range(0, 600, 60)]
    want, _, _ = batches(PROCESSORS[name](), parts)
    monkeypatch.setattr(S, "PACKED", 7)
    got, _, _ = batches(PROCESSORS[name](), parts)
    assert got and got == want


@pytest.mark.parametrize("name", ["count_window", "first_seen"])
def test_arrivals_read_and_write_their_state_once(name):
    make = {
        "count_window": lambda: S.CountWindow("k string, fired_at long, sum long", "vc", 5, 2),
        "first_seen": lambda: S.FirstSeen("k string, seq long, v long", "vc"),
    }[name]
    given = list(rows(2000, SEC))
    large, calls, _ = batches(make(), [given[i : i + 200] for i in range(0, 2000, 200)])
    small, _, _ = batches(make(), [[r] for r in given])
    assert large and sorted(large) == sorted(small)
    assert max(calls) <= 2


@pytest.mark.parametrize("page", [1, 3, 1000])
def test_first_seen_over_pages(monkeypatch, page):
    """Values far apart, close together and null come out once, at their first row, however they are paged."""
    monkeypatch.setattr(S, "PAGE", page)
    given = [(i, None if i % 17 == 0 else (i * 7919 % 211) * (1 << 40 if i % 3 else 1)) for i in range(900)]
    parts = [given[i : i + 150] for i in range(0, 900, 150)]
    processor, handle, out = S.FirstSeen("k string, seq long, v long", "v"), Handle(), []
    processor.init(handle)
    for part in parts:
        out += processor.handleInputRows(("k",), iter([{"_seq": seq, "v": v} for seq, v in reversed(part)]), None)
    want = {}
    for seq, v in given:
        want.setdefault(v, seq)
    assert sorted(tuple(r) for r in out) == sorted(("k", seq, v) for v, seq in want.items())
    pages = processor.pages.held
    assert len(pages) == 1 if page == 1000 else len(pages) > len(want) // page // 4


def test_first_seen_stream_over_pages(spark, folder, monkeypatch):
    data = skewed(600)
    monkeypatch.setattr(S, "PAGE", 4)
    stream = batches_of(spark, f"{folder}/in", split(data, 4)).withColumn("_seq", F.col("seq"))
    out = "id string, seq long, v long"
    got = runner.appended_rows(S.stateful(stream.select("id", "_seq", "vc"), keys=["id"], processor=S.FirstSeen(out, "vc"), output=out), mode="update")
    want = set()
    for key, group in by_key(data).items():
        first = {}
        for r in group:
            first.setdefault(r[3], r[0])
        want |= {(key, seq, v) for v, seq in first.items()}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
