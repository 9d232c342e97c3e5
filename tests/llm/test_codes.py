import hashlib
import math
import random

import numpy as np
import pytest

from samples import pick
from weirstone.llm import codes as C

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n=300, d=32, seed=2):
    rng = np.random.default_rng(seed)
    rows = [(int(i) * 3, rng.normal(0, 0.2, d).astype(np.float32).tolist(), int(i) % 4 if i % 3 else None) for i in range(n)]
    for i in range(n // 3, n // 2, 3):  # copies: ties everywhere
        rows[i] = (rows[i][0], rows[5][1], 1)
    return rows


def odd():
    d = 32
    return [
        (5000, None, 1), (5001, [0.5] * 31 + [None], 1), (5002, [0.5] * 31 + [math.inf], 2), (5003, [math.nan] + [0.1] * 31, None), (5004, [0.0] * d, None),
        (5005, [0.5] * 16, 1), (5006, [], 1), (None, [-0.001] * d, 3), (5007, [300.0, -300.0] * 16, 3),
    ]


def brute(rows, parts=16, entries=64, rounds=2):
    """Plain integers, one part after the other."""
    kept = [(i, [math.floor(256 * np.float64(x)) for x in v], lab) for i, v, lab in rows if v and len(v) == 32 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = 32 // parts
    starts, seen = [], set()
    for i, v, _ in kept:
        if i not in seen and len(starts) < entries:
            seen.add(i)
            starts.append(v)
    books = [[v[p * size : (p + 1) * size] for v in starts] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, v, _ in kept:
                x = v[p * size : (p + 1) * size]
                own.setdefault(near(p, x)[1], []).append(x)
            books[p] = [[sum(c) // len(own[k]) for c in zip(*own[k])] if k in own else e for k, e in enumerate(books[p])]
    out, sums = [], {}
    for i, v, lab in kept:
        found = [near(p, v[p * size : (p + 1) * size]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(f[0] for f in found), lab))
        sums[lab] = sums.get(lab, 0) + out[-1][2]
    text = ",".join(str(x) for p in books for e in p for x in e)
    return [(i, c, e, sums[lab]) for i, c, e, lab in out], hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("chunk, memo", [(C.CHUNK, C.MEMO), (16, 16)])
def test_equals_plain_integers(spark, monkeypatch, chunk, memo):
    """Also when cells are forgotten all the time."""
    monkeypatch.setattr(C, "CHUNK", chunk)
    monkeypatch.setattr(C, "MEMO", memo)
    rows = vectors() + odd() + vectors()[:7]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got, books = C.compressed(df)
    want, digest = brute(rows)
    assert pick(got.withColumn("code", C.hex_code(got["code"])), "vec_id", "code", "error", "label_error") == sorted(want, key=str)
    assert hashlib.sha256(books.listed().encode()).hexdigest() == digest


@pytest.mark.parametrize("spread", [1, 7, 60, 5000])
def test_cells_never_lose_the_nearest(spread):
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread + 1, (64, 4))
    entries[10] = entries[3]
    x = rng.integers(-2 * spread, 2 * spread + 1, (5000, 4))
    own = C.Cells(entries)
    for _ in range(2):  # the second time from memory
        index, distance = own.nearest(x)
        full = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (index == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert own.counts.max() <= 64 and (spread < 60 or own.counts.mean() < 64)


def test_hash_clashes_are_noticed(monkeypatch):
    rng = np.random.default_rng(1)
    entries, x = rng.integers(-50, 50, (64, 4)), rng.integers(-80, 80, (800, 4))
    own = C.Cells(entries)
    own.mix[:] = 0  # every cell has the same hash
    index, _ = own.nearest(x)
    assert (index == ((x[:, None, :] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_few_entries_are_tried():
    rng = np.random.default_rng(3)
    own = C.Cells(rng.integers(-60, 60, (64, 4)))
    own.nearest(rng.integers(-60, 60, (20_000, 4)))
    assert own.counts.mean() < 32


def test_decode(spark):
    rows = vectors(40)
    prepared, length = C.prepared(spark.createDataFrame(rows, SCHEMA))
    books = C.train(prepared, length)
    back = {r["vec_id"]: r["vector"] for r in C.decode(C.encode(prepared, books), books).collect()}
    assert len(back) == 40
    # 64 entries hold all 40 vectors at first, so the parts come back within rounding.
    assert max(abs(a - b) for i, v, _ in rows for a, b in zip(v, back[i])) < 0.6


def test_many_labels_are_salted(spark, monkeypatch):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    want = pick(C.compressed(df)[0], "vec_id", "label", "label_error")
    monkeypatch.setattr(C, "BROADCAST_LABELS", 2)
    assert pick(C.compressed(df)[0], "vec_id", "label", "label_error") == want


def test_limits_and_empty(spark):
    got, books = C.compressed(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and books.listed() == ""
    got, _ = C.compressed(spark.createDataFrame([(1, None, 1)], SCHEMA))
    assert got.count() == 0
    got, _ = C.compressed(spark.createDataFrame([(i, [random.Random(i).random() for _ in range(20)], 1) for i in range(9)], SCHEMA))
    assert {r["error"] for r in got.collect()} == {0}  # 20 components are filled up to 32
    with pytest.raises(Exception, match="components"):
        C.compressed(spark.createDataFrame([(1, [1e30] * 16, 1)], SCHEMA))[0].count()
