"""Scalar, table and aggregate functions; time helpers."""

import pytest
from pyspark.sql import functions as F

from data import by_key, frame, skewed, tuples, us
from weirstone.functions import timecols as T, udfs
from weirstone.functions.hashing import bitmap_offset
from weirstone.operators.running import Blocks
from weirstone.operators.rows import map_with_lifecycle, rebalance, replicate, words
from weirstone.plans.ads import judge_clicks
from weirstone.plans.hot_lists import parse_access_line

ROWS = skewed(300)


def test_durations():
    assert T.micros_of("1 hour 30 seconds") == 3_630_000_000
    with pytest.raises(ValueError):
        T.micros_of("5")


def test_bitmap_offset(spark):
    def fold(text):
        r = 0
        for c in text:
            r += r * 31 + ord(c)
        return r & ((1 << 30) - 1)

    texts = ["", "7", "1035", "937166", "abcdefghijk", "zzzzzzzzzzzzzzzz"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", bitmap_offset(F.col("t")).alias("o"))
    assert {r.t: r.o for r in df.collect()} == {t: fold(t) for t in texts}


def test_access_line(spark):
    line = "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /a.png"
    row = spark.createDataFrame([(line,)], "l string").select(*parse_access_line(F.col("l"))).first()
    assert (row.ip, row.user, str(row.ts), row.method, row.url) == (
        "83.149.9.216", "-", "2015-05-17 10:05:03", "GET", "/a.png"
    )


def test_time_attributes(spark):
    df = spark.range(1).select(
        T.proctime().alias("pt"), T.event_time(F.lit(1).cast("long")).alias("s"),
        T.event_time(F.lit(1500).cast("long"), "millis").alias("m"), T.ddl_rowtime(F.lit(86400).cast("long")).alias("rt"),
    )
    assert [f.dataType.typeName() for f in df.schema] == ["timestamp"] * 4
    row = df.first()
    assert (str(row.s), str(row.m), str(row.rt)) == (
        "1970-01-01 00:00:01", "1970-01-01 00:00:01.500000", "1970-01-02 00:00:00"
    )


def test_user_aggregate_equals_builtin(spark, monkeypatch):
    df = frame(spark, ROWS)
    for limit in (100_000, 2):  # 2: tasks hand partial accumulators on early
        monkeypatch.setattr(udfs, "TASK_GROUPS", limit)
        got = udfs.aggregate_groups(
            df, keys=["id"], columns=["vc"], state="s long, n long",
            accumulate=lambda p: (int(p["vc"].sum()), len(p)), merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
            result=F.col("s") / F.col("n"), name="mean",
        )
        assert tuples(got, "id", "mean") == tuples(df.groupBy("id").agg(F.avg("vc").alias("mean")), "id", "mean")


def test_top_values_keep_duplicates(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 3), ("b", 1)], "id string, vc int")
    got = udfs.top_values(df, keys=["id"], value="vc")
    assert tuples(got, "id", "value", "rank") == [("a", 5, "Top1"), ("a", 5, "Top2"), ("b", 1, "Top1")]


def test_named_functions_in_sql(spark):
    udfs.register_length(spark, "mylen")
    udfs.register_split(spark, "split_words")
    spark.createDataFrame([("ws_001",), (None,)], "id string").createOrReplaceTempView("ids")
    assert tuples(spark.sql("SELECT mylen(id) AS n FROM ids"), "n") == [(6,), (None,)]
    assert tuples(spark.sql("SELECT word FROM ids, LATERAL split_words(id)"), "word") == [("001",), ("ws",)]


def test_lifecycle_closes_each_task(spark, folder):
    def open_task():
        return []

    def close_task(seen):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(len(seen)))

    def batch(seen, pdf):
        seen.append(len(pdf))
        return pdf[["seq"]]

    df = frame(spark, ROWS).repartition(3)
    assert map_with_lifecycle(df, open_task, batch, close_task, "seq long").count() == len(ROWS)
    import os

    assert len(os.listdir(folder)) == 3


def test_row_helpers(spark):
    text = spark.createDataFrame([("hello  world hello",)], "t string")
    assert tuples(words(text, "t"), "word") == [("hello",), ("hello",), ("world",)]
    assert replicate(text, 3).count() == 3
    assert rebalance(frame(spark, ROWS), 5).rdd.getNumPartitions() == 5


def test_blacklist(spark):
    got = judge_clicks(
        frame(spark, ROWS).withColumn("ad", F.lit(1)), user="id", ad="ad", ts="ts", order=["seq"], limit=5
    )
    seen, want = {}, []
    for r in ROWS:
        day = (r[2].timestamp() + 8 * 3600) // 86400
        n = seen[r[1], day] = seen.get((r[1], day), 0) + 1
        want.append((r[0], "pass" if n < 5 else "alert" if n == 5 else "drop"))
    assert tuples(got, "seq", "verdict") == sorted(want, key=str)
    assert len(by_key(ROWS)["hot"]) > 100


PRIME = 10_007


def user():
    """Functions made here are sent to workers whole."""
    prime = PRIME

    def lift(vc):
        return (int(vc) % prime + 1, 1)

    def merge(a, b):
        return (int(a[0]) * int(b[0]) % prime, int(a[1]) + int(b[1]))

    def fold(rows):
        acc = (1, 0)
        for v in rows["vc"].tolist():
            acc = merge(acc, lift(v))
        return acc

    return lift, fold, {"columns": ["vc"], "state": "product long, n long", "merge": merge, "name": "product", "result": F.col("product")}


def product(values):
    acc = 1
    for v in values:
        acc = acc * (v % PRIME + 1) % PRIME
    return acc


@pytest.mark.parametrize("size, slide", [(600, None), (600, 120), (90, 60)])
def test_user_aggregate_in_windows(spark, monkeypatch, size, slide):
    monkeypatch.setattr(udfs, "TASK_GROUPS", 20)
    held = {}
    for _, key, ts, vc in ROWS:
        step = (slide or size) * 10**6
        start = us(ts) // step * step
        while start > us(ts) - size * 10**6:
            held.setdefault((key, start), []).append(vc)
            start -= step
    _, fold, rest = user()
    got = udfs.aggregate_windows(
        frame(spark, ROWS).repartition(5), keys=["id"], ts="ts", size=f"{size} seconds", slide=slide and f"{slide} seconds", accumulate=fold, **rest
    )
    assert {(r["id"], us(r["window_start"])): r["product"] for r in got.collect()} == {k: product(v) for k, v in held.items()}


@pytest.mark.parametrize("rows", [1 << 20, 20])
@pytest.mark.parametrize("keys", [["id"], []])
def test_running_user_aggregate(spark, rows, keys):
    """Also where hot keys are cut into blocks, and a key is null."""
    data = [(s, None if k == "k3" else k, t, v) for s, k, t, v in ROWS]
    seen, want = {}, {}
    for seq, key, _, vc in data:
        own = key if keys else ""
        seen[own] = seen.get(own, 1) * (vc % PRIME + 1) % PRIME
        want[seq] = seen[own]
    lift, _, rest = user()
    got = udfs.running_aggregate(frame(spark, data).repartition(6), keys=keys, order=["seq"], lift=lift, blocks=Blocks(rows=rows), **rest)
    assert got.columns == ["seq", "id", "ts", "vc", "product"]
    assert {r["seq"]: r["product"] for r in got.collect()} == want
