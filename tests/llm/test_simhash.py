import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from samples import corpus, frame, pick, words
from weirstone.llm import simhash as S


def fingerprint(text):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(ws[i : i + 3]), 42) for i in range(max(1, len(ws) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fps, ids):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(i)
    out = [None] * len(fps)
    for members in groups.values():
        known = [ids[m] for m in members if ids[m] is not None]
        for m in members:
            out[m] = min(known) if known else None
    return out


def test_documents(spark):
    rows = corpus()
    rng = random.Random(5)
    base = words(rng, 400)
    for i in range(40):  # near copies
        near = list(base)
        near[rng.randrange(400)] = "changed"
        rows.append((500 + i, " ".join(near), "en", "s", 1))
    got = S.near_duplicates(frame(spark, rows, extra=True))
    fps = [fingerprint(r[1]) for r in rows]
    want = [(r[0], f - (1 << 64) if f >> 63 else f, c) for r, f, c in zip(rows, fps, linked(fps, [r[0] for r in rows]))]
    assert pick(got, "doc_id", "fp", "component_id") == sorted(want, key=str)


@pytest.mark.parametrize("groups", [6, 7, 9])
def test_no_link_is_lost(spark, groups):
    """Chains and clusters of fingerprints, random pairs at 3 and 4 bits."""
    rng = random.Random(9)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for f in fps[:60]:
        for n in (1, 2, 3, 4):
            g = f
            for b in rng.sample(range(64), n):
                g ^= 1 << b
            fps.append(g)
    chain = rng.getrandbits(64)
    for i in range(40):
        chain ^= 0b111 << rng.randrange(60)
        fps.append(chain)
    center = rng.getrandbits(64)
    fps += [center ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)]
    fps = list(dict.fromkeys(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    marks = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(7)
    labels = {r["v"]: r["c"] for r in S.components(S.links(marks, groups)).collect()}
    want = linked(fps, signed)
    ours = {}
    for f, w in zip(signed, want):
        ours.setdefault(labels.get(f, f), set()).add(w)
    assert all(len(v) == 1 for v in ours.values()) and len(ours) == len(set(want))


def test_embedding_never_exceeds_the_distance(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**64, 2000, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 2000, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 2000, dtype=np.uint64))
    assert (np.bitwise_count(S.embedded(a) ^ S.embedded(b)) <= np.bitwise_count(a ^ b)).all()
    df = spark.createDataFrame([(int(x),) for x in a[:200].view(np.int64)], "fp long").select("fp", S.embedding(F.col("fp")).alias("e"))
    assert [r["e"] for r in df.collect()] == S.embedded(a[:200]).view(np.int64).tolist()


def test_one_of_each_component_stays(spark):
    rows = corpus()
    df = frame(spark, rows, extra=True)
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    fps = [fingerprint(r[1]) for r in rows]
    heads = set(linked(fps, [r[0] for r in rows]))
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect()) == sorted(-1 if h is None else h for h in heads)


def test_empty(spark):
    assert S.near_duplicates(frame(spark, [])).count() == 0 and S.keep_one(frame(spark, [])).count() == 0


def test_one_of_each_component_by_its_own_label(spark):
    """Documents without id, and different texts under one id, keep a row for each component."""
    rng = random.Random(12)
    texts = [" ".join(words(rng, 60, 5000)) for _ in range(24)]
    rows = [(None, t, "en", "s", 1) for t in texts[:20]] + [(None, texts[0], "en", "s", 1)]
    rows += [(7, texts[20], "en", "s", 1), (None, texts[20], "en", "s", 1), (8, texts[20], "en", "s", 1)]
    rows += [(3, texts[21], "en", "s", 1), (3, texts[22], "en", "s", 1), (3, texts[22], "en", "s", 1), (None, None, None, None, None)]
    kept = S.keep_one(frame(spark, rows, extra=True))
    want = [(None, t) for t in [*texts[:20], None]] + [(7, texts[20]), (3, texts[21]), (3, texts[22])]
    assert pick(kept, "doc_id", "text") == sorted(want, key=str)
