import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from samples import corpus, frame, pick, words
from weirstone.llm import quality as Q

LABELS = "doc_id long, quality int, toxic int"


def labelled(n=400):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        text = " ".join(w + ("" if good else rng.choice(["###", "%%%", "!!"])) for w in words(rng, rng.randrange(20, 80)))
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = labelled()
    df, told = frame(spark, docs), spark.createDataFrame(labels, LABELS)
    scored = Q.score(df, Q.train(df, told)).select("doc_id", "score", Q.held_out(F.col("doc_id")).alias("held_out")).collect()
    assert {r["doc_id"] for r in scored if r["held_out"]} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1}
    held = [(r["score"] >= 0.5) == (r["doc_id"] % 3 > 0) for r in scored if r["held_out"]]
    assert np.mean(held) > 0.95 and all(0 <= r["score"] <= 1 for r in scored)


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark):
    docs, labels = labelled(150)
    df = frame(spark, docs)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, 1) for i, q, _ in labels]
    one = Q.train(df, spark.createDataFrame(labels, LABELS).repartition(3))
    two = Q.train(frame(spark, [(*d[:2], "xx", "yy", d[4]) for d in docs]), spark.createDataFrame(flipped, LABELS))
    assert np.array_equal(one.w, two.w) and np.array_equal(one.v, two.v) and one.bias == two.bias


def test_sum_of_squares_equals_all_pairs():
    rng = np.random.default_rng(3)
    model = Q.Model(0.3, rng.normal(size=Q.FEATURES), rng.normal(size=(Q.FEATURES, Q.RANK)))
    numbers, x = rng.choice(Q.FEATURES, 12, replace=False), rng.normal(size=12)
    pairs = sum(model.v[a] @ model.v[b] * x[i] * x[j] for i, a in enumerate(numbers) for j, b in enumerate(numbers) if i < j)
    want = 1 / (1 + np.exp(-(0.3 + model.w[numbers] @ x + pairs)))
    assert np.isclose(model.scores(numbers, x, np.array([0]))[0], want)


def test_cases(spark):
    docs = corpus()
    df = frame(spark, docs, extra=True)
    odd = [(0, 1, 0), (0, 0, 0), (1, None, 0), (2, 7, 0), (None, 1, 0), (99_999, 0, 0), (3, 1, 0), (5, 0, 1)]
    out = Q.score(df, Q.train(df, spark.createDataFrame(odd, LABELS)), out="quality_score")
    assert out.columns == [*df.columns, "quality_score"] and out.count() == len(docs)
    assert all(r["quality_score"] is not None and 0 <= r["quality_score"] <= 1 for r in out.collect())


def test_no_labels_and_no_documents(spark):
    none = spark.createDataFrame([], LABELS)
    df = frame(spark, corpus()[:5])
    assert set(pick(Q.score(df, Q.train(df, none)), "score")) == {(0.5,)}
    empty = frame(spark, [])
    assert Q.score(empty, Q.train(empty, none)).count() == 0


def test_sample_is_bounded(spark):
    docs, labels = labelled(90)
    df = frame(spark, docs + docs)
    assert Q.train(df, spark.createDataFrame(labels, LABELS), sample_rows=10).w.any()
