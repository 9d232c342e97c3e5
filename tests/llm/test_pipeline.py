"""The stages on the small tables, each against a plain version of its rule."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_linededup import brute as kept_lines
from test_mixing import brute_targets, totals
from test_simhash import fingerprint, linked
from weirstone.llm import decontaminate, quality
from weirstone.llm.common import saved

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, FOLDER), name.replace(" ", "-"))
        out.append(docs)
    return out


def test_columns(steps):
    for df in steps[:-1]:
        assert df.columns == steps[0].columns and df.dtypes == steps[0].dtypes
    assert steps[-1].columns == [*steps[0].columns, "copy"]


def test_quality_rejects_only_what_is_labelled_bad(spark, steps):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    model = quality.train(steps[0], labels)
    kept = {r[0] for r in rows(quality.score(steps[0], model, out="s").where("s >= 0.5"))}
    assert {r[0] for r in rows(steps[1])} == kept
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    assert len(good - kept) <= 0.02 * len(good)


def test_lines(steps):
    before = rows(steps[1])
    texts = dict(kept_lines(before))
    size = lambda t: len(t.encode().split())
    want = {r[0]: texts[r[0]] for r in before if not size(r[1]) or size(texts[r[0]])}
    assert {r[0]: r[1] for r in rows(steps[2])} == want
    assert all(r[4] == len(r[1]) for r in rows(steps[2]))


def test_near_duplicates(steps):
    before = rows(steps[2])
    ids = [r[0] for r in before]
    assert sorted(r[0] for r in rows(steps[3])) == sorted(set(linked([fingerprint(r[1]) for r in before], ids)))


def test_benchmark(spark, steps):
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    before = {r["doc_id"]: r for r in decontaminate.find(steps[3], bench).collect()}
    after = {r[0]: r[1] for r in rows(steps[4])}
    assert decontaminate.find(steps[4], bench).where("contaminated").count() == 0
    texts = {r[0]: r[1] for r in rows(steps[3])}
    for i, r in before.items():
        assert (i in after) == (r["n_hit"] <= 0.5 * r["n_words"])
        if not r["contaminated"]:
            assert after[i] == texts[i]


def test_mix(steps):
    sizes = totals(rows(steps[4]))
    taken, largest = {}, {}
    for r in rows(steps[5]):
        n = len(r[1].encode().split())
        taken[r[3]] = taken.get(r[3], 0) + n
        largest[r[3]] = max(largest.get(r[3], 0), n)
    for s, target in brute_targets(sizes).items():
        assert abs(taken.get(s, 0) - target) <= largest.get(s, 0) / 2 + 1
    assert steps[5].groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2


def test_run_equals_the_stages(spark, steps):
    assert sorted(rows(corpus_pipeline.run(spark, FOLDER))) == sorted(rows(steps[5]))
