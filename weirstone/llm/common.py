"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from weirstone.session import scratch
from weirstone.sources.files import table

# Bytes of text turned into Python objects at a time.
SLICE_BYTES = 2 << 20


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def saved(df: DataFrame, label: str) -> DataFrame:
    """`df` written to a new table in the shared folder and read again.

    Cuts the lineage: a lost executor costs the files' readers a retry, nothing else.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(columns: Sequence[str], *bases: str) -> list[str]:
    """Column names like `bases` that clash with none of `columns` (case is ignored)."""
    taken, names = {c.lower() for c in columns}, []
    for base in bases:
        name = base
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    """`mapInArrow` for columns of any name, dots included; `run` goes by position."""
    plain = [f"c{i}" for i in range(len(schema))]
    out = StructType([StructField(n, f.dataType) for n, f in zip(plain, schema)])
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(run, out).toDF(*schema.fieldNames())


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about `limit` bytes in a string column; a longer row stands alone."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    yield batch.slice(start)


def as_bytes(array: pa.Array) -> list[bytes]:
    """UTF-8 of a string array, null as empty."""
    return [x or b"" for x in array.cast(pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()).to_pylist()]


def text_mark(text: Column) -> Column:
    """128 bits that stand for a text; a null text has its own."""
    return F.coalesce(F.unhex(F.md5(text)), F.unhex(F.lit("00")))


def one_of_each(docs: DataFrame, labels: DataFrame, *, doc_id: str, text: str) -> DataFrame:
    """One document per label of `labels` (doc_id, mark, c): the smallest id, null last, then the least mark; columns as given.

    `mark` is the text's `text_mark`. Rows with equal id and text are one document; the first that Spark meets stays.
    """
    key, mark, rows = fresh(docs.columns, "key", "mark", "rows")
    # Aggregated per document, then per label: no task sorts the documents without id or those of a large group.
    counted = labels.groupBy("c", "doc_id", "mark").agg(F.count("*").alias("rows"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark", "rows")
    heads = counted.groupBy("c").agg(F.min(place).alias("head"))
    heads = saved(heads.select(F.col("head.doc_id").alias(key), F.col("head.mark").alias(mark), F.col("head.rows").alias(rows)), "heads")
    same = col(doc_id).eqNullSafe(col(key)) & (text_mark(col(text)) == col(mark))
    kept = docs.join(heads.where(col(rows) == 1), same, "left_semi")
    again = heads.where(col(rows) > 1)
    if again.isEmpty():
        return kept
    first = F.first(F.struct(*map(col, docs.columns))).alias(rows)
    more = docs.join(again.drop(rows), same).groupBy(col(key), col(mark)).agg(first)
    return kept.unionByName(more.select(*[col(rows).getField(c).alias(c) for c in docs.columns]))
