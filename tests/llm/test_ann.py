import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirstone.llm import ann as A

VECTORS = "vec_id long, embedding array<float>, leaf int, vector string, score double"


def table(n=3000, d=16, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, d))
    x = (centres[rng.integers(0, 30, n)] + 0.4 * rng.normal(size=(n, d))).astype(np.float32)
    if n > 20:
        x[20] *= 8  # longer than all others, so that its copies come first
    rows = [(i, [float(v) for v in x[i]], 1, "x", 1.0) for i in range(n)]
    return rows + [(n + i, rows[20][1], 1, "x", 1.0) for i in range(300 if n > 20 else 0)]


BAD = [
    (100_000, None, 1, "x", 1.0), (100_020, [0.0] * 16, 1, "x", 1.0), (100_040, [1.0] * 15, 1, "x", 1.0), (100_060, [math.nan] + [1.0] * 15, 1, "x", 1.0),
    (100_080, [math.inf] + [1.0] * 15, 1, "x", 1.0), (None, [1.0] * 16, 1, "x", 1.0), (100_100, [None] + [1.0] * 15, 1, "x", 1.0), (100_120, [], 1, "x", 1.0),
]


def exact(rows, k=20):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = (x * x[i]).sum(axis=1)
        s[ids == ids[i]] = -np.inf
        order = [j for j in np.lexsort((ids, -s))[:k] if s[j] > -np.inf]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


@pytest.mark.parametrize("block", [4096, 150])
def test_recall_and_order(spark, monkeypatch, block):
    monkeypatch.setattr(A, "BLOCK", block)
    rows = table()
    got = A.search(spark.createDataFrame(rows + BAD, VECTORS).repartition(4), F.col("vec_id") % 20 == 0, leaf_rows=100).collect()
    want, found = exact(rows), {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    assert found.keys() == want.keys()
    hits = sum(len({v for v, *_ in found[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    scores = {(q, v): s for q, own in want.items() for v, s in own}
    for q, own in found.items():
        assert [r for *_, r in own] == list(range(1, len(own) + 1)) and q not in {v for v, *_ in own}
        assert own == sorted(own, key=lambda t: (-t[1], t[0]))
        assert all(math.isclose(s, scores[q, v], rel_tol=1e-12) for v, s, _ in own if (q, v) in scores)


def test_copies_tie_to_the_smaller_id(spark):
    rows = table()
    got = A.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 20, leaf_rows=100).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [3000 + i for i in range(20)] and len({r["score"] for r in got}) == 1


def test_few_candidates(spark):
    rows = table(5)[:5] + [(20, table(1)[0][1], 1, "x", 1.0), (20, table(1)[0][1], 1, "x", 1.0)]
    got = A.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0)
    per = {}
    for r in got.collect():
        per.setdefault(r["query_id"], []).append(r["vec_id"])
    # Both rows with id 20 are candidates of 0, and none of itself.
    assert sorted(per[0]) == [1, 2, 3, 4, 20, 20] and sorted(per[20]) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("rows", [[], BAD, table(3)[1:3]])
def test_nothing_to_find(spark, rows):
    assert A.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0).count() == 0
