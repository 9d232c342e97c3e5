import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from samples import corpus, frame, pick, words
from weirstone.llm import importance as I

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, n=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = WORD.findall(lowered)
    return len(ws), [" ".join(ws[i : i + k]) for k in range(1, n + 1) for i in range(len(ws) - k + 1)]


def brute(rows, target):
    counted = [grams(r[1]) for r in rows]
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for total, texts in ((s, [f for _, f in counted]), (t, [grams(x)[1] for x in target])):
        for f in texts:
            for g in f:
                total[zlib.crc32(g.encode()) % 10_000] += 1
    S, T = int(s.sum()), int(t.sum())
    gain = [math.floor(1000 * math.log((int(b) + 1) * (S + 10_000) / ((int(a) + 1) * (T + 10_000)))) for a, b in zip(s, t)]
    found = []
    for r, (n, f) in zip(rows, counted):
        weight = sum(gain[zlib.crc32(g.encode()) % 10_000] for g in f)
        h = int(hashlib.sha256(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        found.append((r[0], len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    enough = sorted((f for f in found if f[4] >= 20), key=lambda f: (-f[3], f[0] is None, f[0] or 0, f[1]))
    places = {}
    for k, f in enumerate(enough[: 5 * len(enough) // 100], 1):
        places.setdefault(f, []).append(k)
    return [(*f[:4], (places.get(f) or [None]).pop(0) if places.get(f) else None) for f in found]


def bench(rng):
    return [" ".join(words(rng, 30, 80)) for _ in range(20)] + [None, "", "Ünï çödé ONE-two_3"]


def sample():
    rng = random.Random(8)
    rows = corpus(400) + [(2000 + i, " ".join(words(rng, 25, 80)), "en", "s", 1) for i in range(60)]
    rows += [(3000, "Ünï,çödé;;ONE two 3 " * 9, "de", "s", 1), (3001, "-- !! ..", "en", "s", 1), (3002, "日本語 テキスト" * 30, "ja", None, 1)]
    return rows, bench(rng)


@pytest.mark.parametrize("parts", [1, 7])
def test_documents(spark, parts):
    rows, target = sample()
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = I.weighed(frame(spark, rows, extra=True).drop("score").repartition(parts), aim, keep=["doc_id"])
    assert pick(got, *got.columns) == sorted(brute(rows, target), key=str)


def test_drawn_documents(spark):
    rows, target = sample()
    df = frame(spark, rows, extra=True)
    aim = spark.createDataFrame([(t, 1) for t in target], "aim string, score int")
    got = I.drawn(df, aim, target_text="aim")
    assert got.columns == df.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(f[0] for f in brute(rows, target) if f[4])
    # Drawn are mostly those that resemble the target.
    assert sum(2000 <= r["doc_id"] < 2060 for r in got.collect()) > 0.8 * got.count()


def test_scan_equals_all_spans():
    rng = random.Random(3)
    for n in (1, 2, 3, 5):
        scan = I.scanner(n)
        for size in (0, 1, 2, 4, 60):
            text = " ".join(words(rng, size)) + rng.choice(["", "!", " é"])
            want = sorted(zlib.crc32(g.encode()) % 10_000 for g in grams(text, n)[1])
            assert sorted(I.features(text.encode(), scan, 10_000)[1].tolist()) == want


def test_long_text_in_chunks(monkeypatch):
    text = " ".join(words(random.Random(1), 20_000, 10_000)).encode()
    whole = I.features(text, I.scanner(3), 10_000)
    monkeypatch.setattr(I, "CHUNK", 100)
    cut = I.features(text, I.scanner(3), 10_000)
    assert cut[0] == whole[0] == 20_000 and (cut[1] == whole[1]).all() and len(cut[1]) == 59_997


def test_equal_rows_and_empty(spark):
    aim = spark.createDataFrame([("a b",)], "text string")
    same = frame(spark, [(7, "w " * 30, "en", "s", 1)] * 50)
    got = I.weighed(same, aim, keep=["doc_id"]).collect()
    assert len({r["score"] for r in got}) == 1 and sorted(r["rank"] for r in got if r["rank"]) == [1, 2]
    assert I.weighed(frame(spark, []), aim).count() == 0
    none = I.weighed(frame(spark, [(1, None, None, None, None), (None, "", None, None, None)]), aim.limit(0), keep=["doc_id"]).collect()
    assert [(r["n_features"], r["weight"], r["rank"]) for r in none] == [(0, 0, None)] * 2
