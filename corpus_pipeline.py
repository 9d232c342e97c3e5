"""A corpus cleaned and mixed in five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirstone.llm import decontaminate, linededup, mixing, quality, simhash
from weirstone.llm.common import fresh, saved
from weirstone.session import prepare
from weirstone.sources.files import table


def _measured(docs: DataFrame) -> DataFrame:
    """`n_chars` brought up to date after a stage that cuts texts."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    (name,) = fresh(docs.columns, "score")
    return quality.score(docs, model, out=name).where(F.col(name) >= 0.5).drop(name)


def no_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeats of runs of lines; those with no other words go."""
    return _measured(linededup.dedup(docs))


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links: three-word shingles, three differing bits at most."""
    return simhash.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; mostly contaminated ones go."""
    return _measured(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, numbered by `copy`."""
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", no_repeated_lines),
    ("near-dedup", no_near_duplicates),
    ("benchmark decontamination", no_benchmark),
    ("mixing sources", mix),
]

# The first stage fits a classifier and the third links fingerprints into groups: no SQL for them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
