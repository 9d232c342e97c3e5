"""Row transforms: map, flatMap, filter, splits and user-visible repartitioning."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType


def project(df: DataFrame, **columns: Column) -> DataFrame:
    """1 -> 1 transform."""
    return df.select(*[c.alias(n) for n, c in columns.items()])


def flat_map(df: DataFrame, items: Column, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """1 -> 0..n transform: one row per element of an array expression."""
    return df.select(*keep, F.explode(items).alias(name))


def words(df: DataFrame, text: str, name: str = "word", sep: str = " ", keep: Sequence[str] = ()) -> DataFrame:
    """Split a line into its non-empty words."""
    return flat_map(df, F.split(F.col(text), sep), name, keep).where(F.col(name) != "")


def map_with_lifecycle(
    df: DataFrame,
    open_task: Callable[[], object],
    row_batch: Callable[[object, object], object],
    close_task: Callable[[object], None],
    schema: StructType | str,
) -> DataFrame:
    """Map with set-up and teardown once per task, over Arrow-backed pandas batches."""

    def run(batches: Iterator) -> Iterator:
        resource = open_task()
        try:
            for batch in batches:
                yield row_batch(resource, batch)
        finally:
            close_task(resource)

    return df.mapInPandas(run, schema)


def tag_split(df: DataFrame, main: Column, main_tag: str = "main", side_tag: str = "side") -> DataFrame:
    """Side output: each row tagged once; a null test goes to the side."""
    tag = F.when(main, main_tag).otherwise(side_tag)
    return df.withColumn("_tag", tag)


def branch(df: DataFrame, tag: str, *columns: Column | str) -> DataFrame:
    """One output of a tagged frame with its own columns."""
    out = df.where(F.col("_tag") == tag)
    return out.select(*columns) if columns else out.drop("_tag")


def write_branches(outputs: dict[str, Callable[[DataFrame, int], None]], columns: dict[str, Sequence]):
    """A `foreachBatch` function that feeds every branch of a tagged stream in one pass."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for tag, sink in outputs.items():
                sink(branch(batch, tag, *columns.get(tag, ())), batch_id)
        finally:
            batch.unpersist()

    return write


def key_groups(df: DataFrame, key: Column, name: str = "key", **aggs: Column) -> DataFrame:
    """Aggregate by a key expression; a constant key is a global aggregate."""
    return df.groupBy(key.alias(name)).agg(*[a.alias(n) for n, a in aggs.items()])


def rebalance(df: DataFrame, n: int | None = None) -> DataFrame:
    """Round-robin redistribution; with no count AQE keeps the partitions even."""
    return df.repartition(n) if n else df.hint("rebalance")


def rescale(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions without a shuffle."""
    return df.coalesce(n)


def to_single_task(aggregated: DataFrame) -> DataFrame:
    """All rows in one partition; for results that were already aggregated."""
    # Not coalesce, which would pull the aggregation itself into one task.
    return aggregated.repartition(1)


def replicate(df: DataFrame, copies: int, name: str = "copy") -> DataFrame:
    """Every row `copies` times, numbered from 0."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
