"""Blocks of hot keys: what one row's block costs, and that it grows with the order column."""

import math
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from data import START
from weirstone.operators import running as hot
from weirstone.operators.rolling import top_changelog
from weirstone.operators.running import BLOCK, Blocks, cut_rows, running, running_count


@pytest.mark.parametrize("keys", [["id"], []])
def test_order_column_is_found_once_a_block(spark, keys):
    """The order column is an expression here; the block's must not hold it more than once, nor search all bounds."""
    rows = [(i, "a" if i % 4 else "b", START + timedelta(minutes=i)) for i in range(400)]
    df = spark.createDataFrame(rows, "seq long, id string, ts timestamp_ntz").select("seq", "id", F.date_trunc("hour", "ts").alias("rt"))
    cut, blocks = cut_rows(df, keys, "rt", Blocks(rows=20))
    plan = cut.select(BLOCK)._jdf.queryExecution().optimizedPlan().toString()
    block = max(plan.splitlines(), key=lambda line: line.count("aggregate(") + line.count("filter("))
    assert blocks is not None and "aggregate(" in block and "filter(" not in block
    assert block.count("date_trunc") + block.count("unix_micros") <= 2


@pytest.mark.parametrize("keys", [["id"], []])
def test_blocks_grow_with_the_order(spark, keys):
    special = [math.nan, math.inf, -math.inf, None, 7.0, 7.0]
    rows = [(i, "a" if i % 9 else "b", special[i % 6] if i % 5 == 0 else (i * 37 % 991) / 3) for i in range(3000)]
    cut, _ = cut_rows(spark.createDataFrame(rows, "seq long, id string, at double").repartition(3), keys, "at", Blocks(rows=25))
    found = {}
    for r in cut.collect():
        order = (0, 0) if r["at"] is None else (2, 0) if math.isnan(r["at"]) else (1, r["at"])
        found.setdefault(r["id"] if keys else "", []).append((order, r[BLOCK]))
    for pairs in found.values():
        numbers = [block for _, block in sorted(pairs)]
        assert numbers == sorted(numbers) and numbers[0] == 0 and len(set(numbers)) > 10
        assert len({o for o, _ in pairs}) >= len(set(numbers))
        assert all(len({b for o, b in pairs if o == order}) == 1 for order, _ in pairs[:200])


def test_over_range_event_with_hot_keys(spark):
    """Peers of an hour share a block, so counts equal those of one key in one task."""
    rows = [(i, "a", START + timedelta(minutes=i)) for i in range(600)]
    df = spark.createDataFrame(rows, "seq long, id string, ts timestamp_ntz").select("seq", "id", F.date_trunc("hour", "ts").alias("rt"))
    got = running(df, keys=["id"], order=["rt"], folds={"ct": running_count()}, blocks=Blocks(rows=50), peers=True)
    hours = {}
    for _, _, ts in rows:
        hours[ts.replace(minute=0)] = hours.get(ts.replace(minute=0), 0) + 1
    want = {h: sum(n for k, n in hours.items() if k <= h) for h in hours}
    assert all(r["ct"] == want[r["rt"].replace(tzinfo=None)] for r in got.collect())


def test_rows_of_hot_keys_are_cut_where_they_are_read(spark):
    """Joined by the key alone before they are cut, all rows of a hot key would meet in one task."""
    rows = [(i, "a" if i % 4 else None, float(i)) for i in range(800)]
    cut, blocks = cut_rows(spark.createDataFrame(rows, "seq long, id string, at double"), ["id"], "at", Blocks(rows=20))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert blocks is not None and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert all(r[BLOCK] >= 0 for r in cut.collect())


def test_cut_of_many_hot_keys(spark, monkeypatch):
    """More hot keys than are listed: the same blocks, by a join of DataFrames."""
    df = spark.createDataFrame([(i, i % 7, float(i * 31 % 501)) for i in range(700)], "seq long, id long, at double")
    listed = cut_rows(df, ["id"], "at", Blocks(rows=20))[0].collect()
    monkeypatch.setattr(hot, "LISTED", 3)
    assert sorted(cut_rows(df, ["id"], "at", Blocks(rows=20))[0].collect()) == sorted(listed)


def test_top_changelog_cuts_hot_keys_once(spark, monkeypatch):
    """The second pass goes by the blocks of the first, and both give what one task would."""
    searched, quantiles = [], hot._quantiles
    monkeypatch.setattr(hot, "_quantiles", lambda x: searched.append(1) or quantiles(x))
    df = spark.createDataFrame([(i, "a" if i % 3 else None, i * 37 % 101) for i in range(400)], "seq long, id string, vc long")
    got = top_changelog(df, keys=["id"], order=["seq"], value="vc", n=2, blocks=Blocks(rows=20))
    assert len(searched) == 1
    plain = top_changelog(df, keys=["id"], order=["seq"], value="vc", n=2, blocks=None)
    assert got.columns == plain.columns and sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
