"""One source with several outputs, restarts, ingest time, and changelogs of top lists."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from data import by_key, frame, skewed
from weirstone.operators.rolling import top_changelog
from weirstone.operators.running import Blocks
from weirstone.plans.reg_runs import JUMP, CountedOnce, FailsOnce, SensorFanout
from weirstone.streaming import feed as feeds
from weirstone.streaming.feed import Feed
from weirstone.streaming.runner import drain

ROWS = skewed(300)


@pytest.mark.parametrize("rows", [1 << 20, 25])
@pytest.mark.parametrize("n", [1, 2, 3])
def test_top_changelog(spark, n, rows):
    want = []
    for key, own in by_key(ROWS).items():
        top = []
        for seq, _, _, vc in own:
            new = sorted([*top, vc], reverse=True)[:n]
            for i in range(n):
                old_v, new_v = (x[i] if i < len(x) else None for x in (top, new))
                if old_v != new_v:
                    want += [(key, seq, i + 1, added, v) for added, v in ((False, old_v), (True, new_v)) if v is not None]
            top = new
    got = top_changelog(frame(spark, ROWS).repartition(4), keys=["id"], order=["seq"], value="vc", n=n, blocks=Blocks(rows=rows))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_fanout(spark, folder):
    rows = [(s, f"s{s % 3}", s * 7 % 5, s * s * 37 % 20_000) for s in range(400)]
    job = SensorFanout(spark, f"{folder}/alerts")
    passes = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            passes.add(batch.num_rows)
            yield batch

    for i in range(4):
        batch = spark.createDataFrame(rows[i * 100 : i * 100 + 100], "seq long, id string, user_id long, vc long")
        for _ in range(2 if i == 2 else 1):  # one batch again
            job(batch.mapInArrow(counted, batch.schema), i)
    # One scan a micro-batch serves both outputs.
    assert passes.value == 500
    want, last = [("count", f"s{k}", None, sum(r[1] == f"s{k}" for r in rows)) for k in range(3)], {}
    for seq, _, user, vc in rows:
        if user in last and abs(vc - last[user]) > JUMP:
            want.append(("alert", str(user), seq, vc))
        last[user] = vc
    assert sorted(map(str, (tuple(r) for r in job.read(spark).collect()))) == sorted(map(str, want))


def words(spark, folder, parts):
    source = f"{folder}/in"
    for i, part in enumerate(parts):
        spark.createDataFrame([(t,) for t in part], "text string").coalesce(1).write.parquet(f"{source}/p{i}")
    return spark.readStream.schema("text string").option("maxFilesPerTrigger", 1).parquet(f"{source}/*")


def test_recovery_between_two_writes(spark, folder):
    job = FailsOnce(spark, f"{folder}/counts")
    drain(words(spark, folder, [["a b a", "c"], ["a"], ["b c c"]]), job, mode="append", restarts=1)
    assert {r["word"]: r["ct"] for r in job.read(spark).collect()} == {"a": 3, "b": 2, "c": 3}
    # The failed batch was tried twice, and the state counts its rows once.
    assert job.tries == [0, 0, 1, 2] and job.rows.before(spark, 3).first()["n"] == 4


def test_no_restart_left(spark, folder):
    class Fails(CountedOnce):
        def between(self, batch_id):
            raise RuntimeError("always")

    job = Fails(spark, f"{folder}/counts")
    with pytest.raises(StreamingQueryException):
        drain(words(spark, folder, [["a"]]), job, mode="append", restarts=2)
    assert job.tries == [0, 0, 0]


def test_slices_carry_the_time_they_came(spark, folder, monkeypatch):
    spark.createDataFrame([(i,) for i in range(90)], "seq long").write.parquet(f"{folder}/t.parquet")
    plain = spark.read.parquet(f"{folder}/t.parquet")
    monkeypatch.setattr(feeds, "table", lambda *_: plain)
    source = Feed(spark, folder, "t", "seq", slice_rows=30, stamp="came")
    seen = []
    drain(source.stream, lambda df, i: seen.append((df.count(), {r["came"] for r in df.collect()}, {r["came"] for r in df.collect()})), mode="append", feed=source)
    assert sum(n for n, _, _ in seen) == 90 and len(seen) >= 2
    # One time a slice, the same on a second look, later from slice to slice.
    assert all(len(a) == 1 and a == b for _, a, b in seen)
    times = [min(a) for _, a, _ in seen]
    assert times == sorted(times) and len(set(times)) == len(times)
    assert os.path.isdir(f"{source.path}/shown")
