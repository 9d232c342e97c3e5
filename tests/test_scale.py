"""Results that must not depend on the layout of files, the size of a key or the type of a value."""

import math
import os
import subprocess
import sys
import textwrap
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

import __spark_entry__ as entry_point
import oracle
from data import START, feed, frame, skewed, split, tuples
from weirstone.operators.counts import count_tumble
from weirstone.operators.running import BLOCK, Blocks, cut_rows, first_value, previous, running, running_count
from weirstone.operators.windows import count_rows, dense_hop, max_of, sum_of
from weirstone.sources.lines import LineSource
from weirstone.streaming import feed as feeds
from weirstone.streaming.runner import RowsDropped, appended_rows

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = "/root/testdata/sf0.001"
SMALL, LARGE = Blocks(rows=20), Blocks(rows=10**6)

ORDERS = {
    "string": ("string", lambda i: f"n{i:05d}"), "utf8": ("string", lambda i: chr(97 + i % 26) + "é" * (i % 3) + str(i)),
    "date": ("date", lambda i: date(2020, 1, 1) + timedelta(days=i)), "decimal": ("decimal(38,2)", lambda i: Decimal(10) ** 30 + Decimal(i) / 4),
    "double": ("double", lambda i: [math.nan, math.inf, -math.inf][i % 3] if i > 220 else i / 7 - 9), "timestamp": ("timestamp", lambda i: START + timedelta(seconds=i)),
}


@pytest.mark.parametrize("kind", ORDERS)
@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("blocks", [SMALL, LARGE])
def test_any_order_and_null_keys(spark, kind, reverse, blocks):
    """Null keys and null order values, hot and not, equal a plain window."""
    ddl, make = ORDERS[kind]
    rows = [(i, [None, "a", "b"][(i // 3) % 3 if i % 4 else 0], None if i % 29 == 7 and kind != "double" else make(i)) for i in range(224)]
    df = spark.createDataFrame(rows, f"seq long, id string, at {ddl}")
    got = running(
        df, keys=["id"], order=["at", "seq"], blocks=blocks, reverse=reverse, folds={"n": running_count(), "p": previous(F.col("seq")), "f": first_value(F.col("seq"))}
    )
    w = Window.partitionBy("id").orderBy(*[F.col(c).desc() if reverse else F.col(c).asc() for c in ("at", "seq")])
    want = df.select("seq", F.row_number().over(w).alias("n"), F.lag("seq").over(w).alias("p"), F.first("seq").over(w).alias("f"))
    assert tuples(got, "seq", "n", "p", "f") == tuples(want, "seq", "n", "p", "f")


def test_order_without_a_number_is_refused_at_any_size(spark):
    df = spark.createDataFrame([("a", [1])], "id string, at array<int>")
    with pytest.raises(TypeError):
        cut_rows(df, ["id"], "at")


def test_count_windows_keep_null_arrivals(spark):
    rows = [(None if i % 10 == 3 else i, "a", i) for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, id string, vc long")
    got = count_tumble(df, keys=["id"], order=["seq", "vc"], size=5, aggs={"n": F.count(F.lit(1))}, blocks=SMALL)
    assert got.count() == 60


def test_one_statistics_pass(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b", i) for i in range(100)], "seq long, id string, vc long")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        running(df, keys=["id"], order=["seq"], folds={"n": running_count()})
        jobs = tracker.getJobIdsForGroup("build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2  # the stages of one aggregate


def panes(rows, size, step):
    """Brute force: {(key, pane start): values} in seconds."""
    found = {}
    for key, at, v in rows:
        pane = at // step * step
        while pane > at - size:
            found.setdefault((key, pane), []).append(v)
            pane -= step
    return found


@pytest.mark.parametrize("with_max", [False, True])
def test_dense_doubles(spark, with_max):
    """Large beside small, nulls only, and infinite values."""
    rows = [("a", 0, 1e17), ("a", 100, 0.5), ("a", 200, None), ("b", 0, math.inf), ("b", 90, 1.0), ("b", 300, -2.5), ("c", 5, 0.1), ("c", 6, 0.2)]
    df = spark.createDataFrame([(k, START + timedelta(seconds=s), v) for k, s, v in rows], "id string, ts timestamp, v double")
    measures = {"s": sum_of("v"), "n": count_rows(), **({"hi": max_of("v")} if with_max else {})}
    got = dense_hop(df, keys=["id"], ts="ts", size="20 seconds", slide="5 seconds", measures=measures)
    at = {(r["id"], (r["window_start"] - START).total_seconds()): (r["s"], r["n"]) for r in got.collect()}
    want = {k: (sum(x for x in v if x is not None) if any(x is not None for x in v) else None, len(v)) for k, v in panes(rows, 20, 5).items()}
    assert at.keys() == want.keys()
    for k, (s, n) in want.items():
        assert at[k][1] == n and (at[k][0] == s or math.isclose(at[k][0], s, rel_tol=1e-12)), (k, at[k], s)


def test_dense_longs_over_many_stretches(spark, monkeypatch):
    monkeypatch.setattr("weirstone.operators.windows.TIME_STEPS", 7)
    rows = [("a" if i % 3 else None, i * 13 % 997, None if i % 5 == 0 else i) for i in range(300)]
    df = spark.createDataFrame([(k, START + timedelta(seconds=s), v) for k, s, v in rows], "id string, ts timestamp, v long")
    got = dense_hop(df, keys=["id"], ts="ts", size="20 seconds", slide="5 seconds", measures={"s": sum_of("v"), "n": count_rows()})
    at = {(r["id"], (r["window_start"] - START).total_seconds()): (r["s"], r["n"]) for r in got.collect()}
    want = {k: (sum(x for x in v if x is not None) if any(x is not None for x in v) else None, len(v)) for k, v in panes(rows, 20, 5).items()}
    assert at == want


STREAMS = ["stream_hop", "stream_interval_join", "stream_distinct", "stream_changelog", "stream_count_slide", "stream_vc_jump", "stream_first_seen",
           "stream_switch", "stream_daily_limit", "watermark_bounded", "wordcount_stream", "upsert_agg_docs", "sink_foreach", "stream_order_timeout", "stream_session", "stream_late_firings"]


@pytest.fixture(scope="module")
def scattered(spark, tmp_path_factory):
    """The tables with events in 200 files, in no order, and documents in 20."""
    folder = str(tmp_path_factory.mktemp("scattered"))
    for name in oracle.TABLES:
        source = spark.read.parquet(f"{TABLES}/{name}.parquet")
        files = {"events": 200, "documents": 20}.get(name)
        (source.orderBy(F.rand(5)).repartition(files) if files else source).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="tables not present")
@pytest.mark.parametrize("name", STREAMS)
def test_streams_do_not_depend_on_files(spark, scattered, monkeypatch, name):
    monkeypatch.setattr(feeds, "SLICE_ROWS", 50 if name == "wordcount_stream" else 250)
    con = oracle.connect(TABLES)
    assert oracle.differences(entry_point.queries()[name](spark, scattered), con, entry_point.oracle_sql()[name]) == []


def test_strings_with_a_common_beginning_are_cut(spark):
    rows = [("hot" if i % 4 else f"k{i % 5}", f"https://example.org/2024-01-{i:06d}", i) for i in range(600)]
    df = spark.createDataFrame(rows, "id string, at string, vc long").repartition(4)
    for keys in (["id"], []):
        cut, blocks = cut_rows(df, keys, "at", Blocks(rows=40))
        assert blocks is not None and cut.where("_blk >= 0").groupBy("_blk").count().agg(F.max("count")).first()[0] < 80
        got = running(df, keys=keys, order=["at"], folds={"n": running_count()}, blocks=Blocks(rows=40))
        seen, want = {}, {}
        for key, at, _ in rows:
            own = key if keys else ""
            want[at] = seen[own] = seen.get(own, 0) + 1
        assert {r["at"]: r["n"] for r in got.collect()} == want


def test_dropped_rows_are_an_error(spark, folder):
    rows = skewed(60)
    late = [rows[40:], rows[:20], [(99, "z", START + timedelta(days=9), 1)], rows[20:40]]
    counts = feed(spark, f"{folder}/in", late).withWatermark("ts", "1 second").groupBy(F.window("ts", "5 seconds")).count()
    with pytest.raises(RowsDropped):
        appended_rows(counts.select("count"))


def test_line_stream_takes_a_late_file_that_sorts_first(spark, folder):
    spark.dataSource.register(LineSource)
    os.makedirs(f"{folder}/in")

    def put(name, text):
        with open(f"{folder}/in/{name}", "w") as out:
            out.write(text)

    def go():
        stream = spark.readStream.format("lines_of").schema("v string").option("path", f"{folder}/in").load()
        return sorted(r["v"] for r in appended_rows(stream, checkpoint=f"{folder}/cp", path=f"{folder}/out").collect())

    put("b", "1\n2\n")
    assert go() == ["1", "2"]
    put("a", "3\n")
    assert go() == ["1", "2", "3"]


def test_workers_get_the_package(tmp_path):
    """A session started elsewhere, without PYTHONPATH, runs Python operators and a stateful stream."""
    code = f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        import __spark_entry__ as e
        from weirstone.session import build_session
        spark = build_session("away", master="local[2]", spark_ui_enabled="false", spark_sql_shuffle_partitions="2")
        for name in ("udaf_avg", "custom_source", "stream_vc_jump"):
            assert e.queries()[name](spark, {TABLES!r}).count() > 0, name
        print("fine")
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-3000:]
