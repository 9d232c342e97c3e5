import pytest
from pyspark.sql import functions as F

from samples import corpus, frame, pick
from weirstone.llm import mixing as M


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=str.encode) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = sum(weight[s] for s in names if s not in full)
        rate = (total - sum(2 * sizes[s] for s in full)) / rest if rest else 0
        more = {s for s in names if s not in full and rate * weight[s] > 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in full else rate * weight[s] for s in names}
        full |= more


def totals(docs):
    sizes = {}
    for r in docs:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").encode().split())
    return sizes


@pytest.mark.parametrize("cell_rows", [3, 10, M.CELL_ROWS])
def test_plan(spark, cell_rows):
    docs = corpus()
    rows = M.plan(frame(spark, docs, extra=True), cell_rows=cell_rows).collect()
    sizes = totals(docs)
    want = brute_targets(sizes)
    assert len(rows) == len(docs)
    taken, largest = {}, {}
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-12)
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6


def test_cells_change_nothing_and_reruns_agree(spark):
    df = frame(spark, corpus())
    first = pick(M.plan(df), "doc_id", "size", "copies")
    assert first == pick(M.plan(df.repartition(5)), "doc_id", "size", "copies") == pick(M.plan(df, cell_rows=4), "doc_id", "size", "copies")


def test_order_is_by_key(spark):
    """A partial epoch takes the smallest keys of its source."""
    rows = M.plan(frame(spark, corpus()), cell_rows=4).collect()
    for s in {r["source"] for r in rows}:
        own = sorted((r for r in rows if r["source"] == s and r["size"]), key=lambda r: (r["key"], r["doc_id"] is not None, r["doc_id"] or 0))
        copies = [r["copies"] for r in own]
        assert copies == sorted(copies, reverse=True)


def test_mixed_rows(spark):
    df = frame(spark, corpus(), extra=True)
    out = M.mixed(df)
    assert out.columns == [*df.columns, "copy"]
    counted = {}
    for r in out.collect():
        counted[r["doc_id"], r["text"], r["source"]] = counted.get((r["doc_id"], r["text"], r["source"]), 0) + 1
    want = {}
    for r in M.plan(df).collect():
        want.setdefault((r["doc_id"], r["source"]), []).append(r["copies"])
    assert {(k[0], k[2]): n for k, n in counted.items()} == {k: sum(v) for k, v in want.items() if sum(v)}


def test_columns_that_clash(spark):
    df = frame(spark, corpus(), extra=True)
    for name in ("key_", "copy", "Own", "from", "times", "id"):
        df = df.withColumn(name, F.lit(5))
    out = M.mixed(df)
    assert out.columns == [*df.columns, "copy_"]
    assert pick(out, "doc_id", "text", "copy_") == pick(M.mixed(frame(spark, corpus())), "doc_id", "text", "copy")
    assert {r["copy"] for r in out.select("copy").collect()} == {5}


def test_empty(spark):
    assert M.plan(frame(spark, [])).count() == 0 and M.mixed(frame(spark, [])).count() == 0
    none = frame(spark, [(1, None, None, None, None), (2, "", "en", "a", 0)])
    assert {r["copies"] * r["size"] for r in M.plan(none).collect()} == {0}


def low_quality(n=30_000):
    """A source with nine texts of ten of the least quality."""
    return [(i, f"w{i} " + ("word " * (i % 7 + 1) if i % 10 == 0 else "#$% " * (i % 7 + 1)), "en", "hot" if i % 3 else "b", 1) for i in range(n)]


def test_the_last_cell_is_small_whatever_the_quality(spark):
    docs = frame(spark, low_quality())
    slim = M.saved(M.sized(docs, "doc_id", "text", "source", None), "sizes")
    for share in (0.1, 0.9, 0.999):
        sums = slim.groupBy(F.col("source").alias("name")).agg(F.count("*").alias("n"), (F.sum("size") * share).alias("budget"))
        cells = M.narrowed(slim, sums, 100).collect()
        assert len(cells) == 2
        for r in cells:
            own = slim.where((F.col("source") == r["name"]))
            assert r["rows"] == own.where(F.col("spread").between(r["lo"], r["hi"])).count() <= 400
            assert r["before"] == (own.where(F.col("spread") < r["lo"]).agg(F.sum("size")).first()[0] or 0)
            upto = own.where(F.col("spread") <= r["hi"]).agg(F.sum("size")).first()[0]
            assert r["before"] < r["budget"] <= upto


def test_one_key_of_many_rows(spark):
    """Rows equal in id and text share a key; their cell cannot be cut."""
    rows = [(1, "a b c", "en", "s", 1)] * 300 + [(2, "d e", "en", "s", 1)]
    got = M.plan(frame(spark, rows), cell_rows=5).collect()
    assert len(got) == 301 and abs(sum(r["copies"] * r["size"] for r in got) - 1.5 * 902) <= 1.5
