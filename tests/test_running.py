"""Rolling operators against plain loops, with and without hot keys."""

import pytest
from pyspark.sql import functions as F

from data import by_key, frame, skewed, tuples
from weirstone.operators import rolling as R
from weirstone.operators.counts import count_slide, count_tumble
from weirstone.operators.over import over_unbounded
from weirstone.operators.running import (
    BLOCK,
    Blocks,
    cut_rows,
    first_value,
    last_known,
    last_known_before,
    previous,
    running,
    running_count,
    running_max,
    running_max_before,
    running_min,
    running_sum,
    trailing_rows,
)

SMALL = Blocks(rows=40, limit=1000)
CASES = pytest.mark.parametrize("blocks", [SMALL, Blocks(rows=40, limit=3), None])


@pytest.fixture(scope="module")
def rows():
    return skewed()


@CASES
@pytest.mark.parametrize("reverse", [False, True])
def test_folds(spark, rows, blocks, reverse):
    even = F.when(F.col("vc") % 2 == 0, F.col("vc"))
    out = running(
        frame(spark, rows), keys=["id"], order=["seq"], blocks=blocks, reverse=reverse,
        folds={
            "n": running_count(), "s": running_sum(F.col("vc")), "hi": running_max(F.col("vc")),
            "hib": running_max_before(F.col("vc")), "lo": running_min(F.col("vc")),
            "f": first_value(F.col("vc")), "p": previous(F.col("vc")), "l": last_known(even),
            "lb": last_known_before(even),
        },
    )
    want = []
    for group in by_key(rows).values():
        seen = []
        for r in reversed(group) if reverse else group:
            evens = [v for v in seen if v % 2 == 0]
            before = max(seen) if seen else None
            prev = seen[-1] if seen else None
            last_before = evens[-1] if evens else None
            seen.append(r[3])
            last = r[3] if r[3] % 2 == 0 else last_before
            want.append((r[0], len(seen), sum(seen), max(seen), before, min(seen), seen[0], prev, last, last_before))
    assert tuples(out, "seq", "n", "s", "hi", "hib", "lo", "f", "p", "l", "lb") == sorted(want, key=str)


@CASES
def test_global_order(spark, rows, blocks):
    out = running(frame(spark, rows), keys=[], order=["seq"], blocks=blocks, folds={"s": running_sum(F.col("vc"))})
    total, want = 0, []
    for r in rows:
        total += r[3]
        want.append((r[0], total))
    assert tuples(out, "seq", "s") == sorted(want, key=str)


@CASES
@pytest.mark.parametrize("keys", [[], ["id"]])
def test_peers_share_a_value(spark, rows, blocks, keys):
    out = over_unbounded(frame(spark, rows), keys=keys, order=["ts"], blocks=blocks, folds={"n": running_count()})
    want = [
        (r[0], sum(1 for q in rows if q[2] <= r[2] and (not keys or q[1] == r[1]))) for r in rows
    ]
    assert tuples(out, "seq", "n") == sorted(want, key=str)


def test_only_hot_keys_are_cut(spark, rows):
    cut, blocks = cut_rows(frame(spark, rows), ["id"], "seq", Blocks(rows=200))
    assert blocks is not None
    pieces = {r["id"]: r["n"] for r in cut.groupBy("id").agg(F.count_distinct(BLOCK).alias("n")).collect()}
    assert pieces.pop("hot") > 2 and set(pieces.values()) == {1}


def test_blocks_follow_bursts(spark):
    """Nine tenths of the rows in one of a thousand hours still spread."""
    burst = [(i, "a", 500_000 + i % 900) for i in range(9000)] + [(9000 + i, "a", i * 1000) for i in range(1000)]
    df = spark.createDataFrame(burst, "seq long, id string, at long")
    cut, _ = cut_rows(df, [], "at", Blocks(rows=100))
    biggest = cut.groupBy(BLOCK).count().agg(F.max("count")).first()[0]
    assert biggest < 1000
    edges = cut.groupBy(BLOCK).agg(F.min("at").alias("lo"), F.max("at").alias("hi")).orderBy(BLOCK).collect()
    assert all(a.hi < b.lo for a, b in zip(edges, edges[1:]))


def test_small_input_needs_no_join(spark, rows):
    out = running(frame(spark, rows[:30]), keys=["id"], order=["seq"], folds={"n": running_count()})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_two_keys_hot_pair(spark, rows):
    df = frame(spark, rows).withColumn("g", F.col("seq") % 2)
    out = running(df, keys=["id", "g"], order=["seq"], blocks=SMALL, folds={"n": running_count()})
    seen, want = {}, []
    for r in rows:
        seen[r[1], r[0] % 2] = seen.get((r[1], r[0] % 2), 0) + 1
        want.append((r[0], seen[r[1], r[0] % 2]))
    assert tuples(out, "seq", "n") == sorted(want, key=str)


@CASES
@pytest.mark.parametrize("chunk", [7, 1 << 16])
def test_trailing_rows(spark, rows, blocks, chunk):
    out = trailing_rows(
        frame(spark, rows), keys=["id"], order=["seq"], preceding=4, chunk=chunk, blocks=blocks,
        aggs={"s": F.sum("vc"), "c": F.count(F.lit(1))},
    )
    want = []
    for group in by_key(rows).values():
        for i, r in enumerate(group):
            last = [q[3] for q in group[max(0, i - 4) : i + 1]]
            want.append((r[0], i + 1, sum(last), len(last)))
    assert tuples(out, "seq", "n", "s", "c") == sorted(want, key=str)


@CASES
def test_count_windows(spark, rows, blocks):
    aggs = {"s": F.sum("vc")}
    df = frame(spark, rows)
    tumble = count_tumble(df, keys=["id"], order=["seq"], size=5, aggs=aggs, blocks=blocks)
    slide = count_slide(df, keys=["id"], order=["seq"], size=5, slide=2, aggs=aggs, blocks=blocks)
    full = count_slide(df, keys=["id"], order=["seq"], size=5, slide=2, aggs=aggs, full_only=True, blocks=blocks)
    want_t, want_s = [], []
    for key, group in by_key(rows).items():
        vals = [r[3] for r in group]
        want_t += [(key, i // 5, sum(vals[i : i + 5])) for i in range(0, len(vals) - 4, 5)]
        want_s += [(key, n, sum(vals[max(0, n - 5) : n])) for n in range(2, len(vals) + 1, 2)]
    assert tuples(tumble, "id", "window_no", "s") == sorted(want_t, key=str)
    assert tuples(slide, "id", "fired_at", "s") == sorted(want_s, key=str)
    assert tuples(full, "id", "fired_at", "s") == sorted([w for w in want_s if w[1] >= 5], key=str)


@CASES
def test_running_top(spark, rows, blocks):
    out = R.running_top(frame(spark, rows), keys=["id"], order=["seq"], value="vc", n=3, blocks=blocks)
    want = []
    for group in by_key(rows).values():
        for i, r in enumerate(group):
            want.append((r[0], sorted((q[3] for q in group[: i + 1]), reverse=True)[:3]))
    assert tuples(out, "seq", "top") == sorted(want, key=str)


@CASES
def test_max_keeps_first_row_max_by_takes_newest(spark, rows, blocks):
    df = frame(spark, rows)
    plain = R.rolling_max(df, keys=["id"], order=["seq"], value="vc", keep=["ts"], blocks=blocks)
    newest = R.rolling_max_by(df, keys=["id"], order=["seq"], value="vc", keep=["seq"], blocks=blocks)
    oldest = R.rolling_max_by(
        df, keys=["id"], order=["seq"], value="vc", keep=["seq"], newest_on_tie=False, blocks=blocks
    )
    want_p, want_n, want_o = [], [], []
    for group in by_key(rows).values():
        for i, r in enumerate(group):
            top = max(q[3] for q in group[: i + 1])
            holders = [q[0] for q in group[: i + 1] if q[3] == top]
            want_p.append((r[0], group[0][2], top))
            want_n.append((r[0], top, holders[-1]))
            want_o.append((r[0], top, holders[0]))
    assert tuples(plain, "seq", "first_ts", "max_vc") == sorted(want_p, key=str)
    assert tuples(newest, "seq", "best_vc", "best_seq") == sorted(want_n, key=str)
    assert tuples(oldest, "seq", "best_vc", "best_seq") == sorted(want_o, key=str)


def test_changelog_folds_to_the_count(spark, rows):
    log = R.changelog_count(frame(spark, rows), keys=["id"], order=["seq"], blocks=SMALL)
    signed = F.when(F.col("added"), F.col("ct")).otherwise(-F.col("ct"))
    final = log.groupBy("id").agg(F.sum(signed).alias("ct"))
    assert tuples(final, "id", "ct") == sorted(((k, len(g)) for k, g in by_key(rows).items()), key=str)


def test_distinct_and_running_uv(spark, rows):
    df = frame(spark, rows)
    first = R.first_per_key(df, keys=["id", "vc"], order=["seq"])
    uv = R.running_distinct(df, value="id", order=["seq"], blocks=SMALL)
    seen, pairs, want = [], {}, []
    for r in rows:
        pairs.setdefault((r[1], r[3]), r[0])
        if r[1] not in seen:
            seen.append(r[1])
            want.append((r[0], r[1], len(seen)))
    assert tuples(first, "id", "vc", "seq") == sorted(((k, v, s) for (k, v), s in pairs.items()), key=str)
    assert tuples(uv, "seq", "id", "uv") == sorted(want, key=str)
