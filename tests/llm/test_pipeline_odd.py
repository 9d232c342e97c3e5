"""The pipeline on empty tables, nulls, repeated rows and columns that clash."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from samples import DOCS, corpus, frame
from weirstone.llm.common import saved


def put(spark, folder, name, rows, schema):
    """One file, as the tables are."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


@pytest.fixture
def tables(spark, folder):
    def make(docs, labels, bench):
        os.makedirs(folder, exist_ok=True)
        put(spark, folder, "documents", docs, DOCS)
        put(spark, folder, "labels", labels, "doc_id long, quality int, toxic int")
        put(spark, folder, "benchmark", bench, "item_id long, text string")
        return folder

    return make


def test_empty_tables(spark, tables):
    out = corpus_pipeline.run(spark, tables([], [], []))
    assert out.count() == 0 and out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy"]


def test_nulls_and_repeated_rows(spark, tables):
    docs = corpus()
    labels = [(i, i % 2, 0) for i in range(40)] + [(None, 1, 1), (3, None, None), (4, 7, 0)]
    rows = corpus_pipeline.run(spark, tables(docs, labels, [(1, docs[9][1]), (None, None), (2, "")])).collect()
    texts = {r[1] for r in docs}
    assert rows and max(r["copy"] for r in rows) <= 2
    kept = {}
    for r in rows:
        kept.setdefault(r["text"], set()).add(r["doc_id"])
    # Copies are one document, in all its copies of the mix.
    assert all(len(ids) == 1 for ids in kept.values())
    assert sum(t in texts for t in kept) >= 0.9 * len(kept)


def test_no_labels_rejects_nothing(spark, tables):
    docs = [(i, f"some plain words number {i} " + "w" * i, "en", "s", None) for i in range(30)]
    folder = tables(docs, [], [])
    assert corpus_pipeline.good_quality(spark, spark.createDataFrame(docs, DOCS), folder).count() == 30


def test_columns_that_clash(spark, tables):
    docs = corpus()
    folder = tables(docs, [(i, 1, 0) for i in range(60)], [(1, docs[9][1])])
    df = frame(spark, docs, extra=True).withColumn("copy", F.lit(9))
    for name, stage in corpus_pipeline.STAGES:
        before, df = df, saved(stage(spark, df, folder), name.replace(" ", "-"))
        assert df.columns[: len(before.columns)] == before.columns, name
    assert df.columns[-1] == "copy_" and {r["copy"] for r in df.select("copy").collect()} == {9}
