"""What is carried to the blocks of hot keys: rows are dealt out once, and a row's block is found once a pass."""

import pytest
from pyspark.sql import functions as F

from weirstone.operators.firings import late_firings
from weirstone.operators.over import over_unbounded
from weirstone.operators.running import BLOCK, WHOLE, Blocks, cut_rows, first_value, running, running_count, running_sum


@pytest.mark.parametrize("keys", [["id"], []])
@pytest.mark.parametrize("nulls", [False, True])
def test_rows_of_blocks_are_dealt_out_once(spark, keys, nulls):
    """A carry side of unknown size was joined by a second shuffle and sort of all rows."""
    key = F.when(F.col("seq") % 4 > 0, "a") if nulls else F.when(F.col("seq") % 4 > 0, "a").otherwise("b")
    df = spark.range(4000).select(F.col("id").alias("seq"), key.alias("id"), F.lit("some more bytes").alias("text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20KB")
    try:
        out = running(df, keys=keys, order=["seq"], blocks=Blocks(rows=100), folds={"n": running_count(), "f": first_value(F.col("seq"))})
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = out.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
    seen, first = {}, {}
    for r in sorted(got, key=lambda r: r["seq"]):
        own = r["id"] if keys else ""
        seen[own] = seen.get(own, 0) + 1
        assert (r["n"], r["f"]) == (seen[own], first.setdefault(own, r["seq"]))
    assert len(got) == 4000


@pytest.mark.parametrize("keys", [["id"], []])
def test_a_filter_does_not_find_the_block_again(spark, keys):
    df = spark.range(800).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("id"))
    cut, _ = cut_rows(df, keys, "seq", Blocks(rows=20))
    plan = cut.where(F.col(BLOCK) != WHOLE).groupBy(BLOCK).count()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
    assert not [line for line in plan.splitlines() if "Filter" in line and "aggregate(" in line]


def _scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Range (")


def test_result_of_a_global_order_reads_its_rows_once(spark):
    """The totals were a branch of the result, which read and searched all rows again whenever it was used."""
    df = spark.range(600).select(F.col("id").alias("seq"), (F.col("id") % 7).alias("vc"))
    out = over_unbounded(df, order=["seq"], folds={"s": running_sum(F.col("vc"))}, blocks=Blocks(rows=50))
    assert _scans(out) == 1
    assert {r["seq"]: r["s"] for r in out.collect()} == {i: sum(k % 7 for k in range(i + 1)) for i in range(600)}


def test_late_firings_read_rows_once_for_each_kind(spark):
    """Rows in time and late rows: two reads, without two more of the totals behind the watermark."""
    ts = F.timestamp_seconds(F.col("id") * 60 - F.when(F.col("id") % 5 == 0, 9000).otherwise(0) + 1_700_000_000)
    df = spark.range(600).select(F.col("id").alias("seq"), F.lit("a").alias("id"), ts.alias("ts"))
    sizes = {"keys": ["id"], "ts": "ts", "order": ["seq"], "size": "1 hour", "delay": "1 hour", "lateness": "3 hours", "folds": {"n": running_count()}}
    cut, plain = (late_firings(df, blocks=blocks, **sizes) for blocks in (Blocks(rows=200), None))
    # The totals of the rows in time are read for their firing, and for the late ones.
    assert _scans(cut) <= 3
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))
    assert cut.where("firing > 1").count() > 50
