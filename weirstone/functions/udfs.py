"""User function surface: scalar, table, aggregate and table-aggregate functions.

Built-in expressions come first; the Python forms are the extension points, all
Arrow-batched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import repeat
from math import gcd

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from weirstone.functions.timecols import epoch_micros, floor_to, from_micros, micros_of
from weirstone.operators.running import BLOCK, DEFAULT_BLOCKS, WHOLE, Blocks, cut_rows, same_keys
from weirstone.schemas import struct


def register_length(spark: SparkSession, name: str = "mylen") -> Callable:
    """Scalar function over Arrow batches, callable by name in SQL or inline."""

    @F.pandas_udf("int")
    def length(values: pd.Series) -> pd.Series:
        return values.str.len().astype("Int32")

    spark.udf.register(name, length)
    return length


def register_split(spark: SparkSession, name: str = "split_words", sep: str = "_") -> None:
    """Table function: one `word` row per part of its argument."""

    @F.udtf(returnType="word string", useArrow=True)
    class SplitWords:
        def eval(self, text: str) -> Iterator[tuple[str]]:
            if text is not None:
                for word in text.split(sep):
                    yield (word,)

    spark.udtf.register(name, SplitWords)


def split_rows(df: DataFrame, text: str, sep: str = "_", name: str = "word") -> DataFrame:
    """The same table function as a built-in lateral explode."""
    return df.select("*", F.explode(F.split(F.col(text), sep)).alias(name))


# Groups a task keeps before it hands partial accumulators on.
TASK_GROUPS = 100_000


Accumulate = Callable[[pd.DataFrame], tuple]
Merge = Callable[[tuple, tuple], tuple]


def partial_states(df: DataFrame, *, keys: Sequence[str], columns: Sequence[str], state: StructType | str, accumulate: Accumulate, merge: Merge) -> DataFrame:
    """Accumulators (keys, fields of `state`), merged per task: a key has a few per task, however many rows it has."""
    keys, fields = list(keys), struct(state) if isinstance(state, str) else state
    names = fields.fieldNames()
    schema = StructType([df.schema[k] for k in keys] + list(fields.fields))

    def rows(held: dict) -> pd.DataFrame:
        return pd.DataFrame([(*k, *acc) for k, acc in held.items()], columns=keys + names)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            for key, part in batch.groupby(keys, dropna=False, sort=False):
                acc = accumulate(part)
                held[key] = merge(held[key], acc) if key in held else acc
            if len(held) > TASK_GROUPS:
                yield rows(held)
                held = {}
        if held:
            yield rows(held)

    return df.select(*keys, *columns).mapInPandas(partial, schema)


def merged_states(states: DataFrame, *, keys: Sequence[str], state: StructType | str, merge: Merge) -> DataFrame:
    """One accumulator per key."""
    keys, fields = list(keys), struct(state) if isinstance(state, str) else state
    names = fields.fieldNames()
    schema = StructType([states.schema[k] for k in keys] + list(fields.fields))

    def final(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = None
        for batch in batches:
            for part in batch[names].itertuples(index=False, name=None):
                acc = part if acc is None else merge(acc, part)
        yield pd.DataFrame([(*key, *acc)], columns=keys + names)

    return states.select(*keys, *names).groupBy(*keys).applyInPandas(final, schema)


def aggregate_groups(
    df: DataFrame,
    *,
    keys: Sequence[str],
    columns: Sequence[str],
    state: StructType | str,
    accumulate: Accumulate,
    merge: Merge,
    result: Column,
    name: str,
) -> DataFrame:
    """User aggregate with accumulate / merge / result.

    `accumulate` turns one key's rows of an Arrow batch into an accumulator (the
    fields of `state`), `merge` combines two. Tasks merge their own accumulators
    before the shuffle, so a key reaches its final merge with a few rows per task
    however many rows it has. `result` is an expression over the state fields.
    """
    partials = partial_states(df, keys=keys, columns=columns, state=state, accumulate=accumulate, merge=merge)
    return merged_states(partials, keys=keys, state=state, merge=merge).select(*keys, result.alias(name))


def aggregate_windows(
    df: DataFrame, *, keys: Sequence[str], ts: str, size: str, slide: str | None = None, columns: Sequence[str], state: StructType | str,
    accumulate: Accumulate, merge: Merge, result: Column, name: str,
) -> DataFrame:
    """The user aggregate in tumbling (`slide` None) or sliding windows: (keys, window_start, window_end, name).

    Rows are accumulated once per slice, the time unit that size and slide have in common;
    a window merges the accumulators of its slices, so rows are never copied per window.
    """
    keys, size_us, slide_us = list(keys), micros_of(size), micros_of(slide or size)
    unit = gcd(size_us, slide_us)
    sliced = df.where(F.col(ts).isNotNull()).withColumn("_start", floor_to(epoch_micros(ts), unit))
    by = [*keys, "_start"]
    states = partial_states(sliced, keys=by, columns=columns, state=state, accumulate=accumulate, merge=merge)
    if slide_us != size_us:
        states = merged_states(states, keys=by, state=state, merge=merge)
        first, last = floor_to(F.col("_start") - size_us, slide_us) + slide_us, floor_to(F.col("_start"), slide_us)
        states = states.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")
        states = states.withColumn("_start", F.explode(F.sequence("_first", "_last", F.lit(slide_us)))).drop("_first", "_last")
    whole = merged_states(states, keys=by, state=state, merge=merge)
    return whole.select(*keys, from_micros(F.col("_start")).alias("window_start"), from_micros(F.col("_start") + size_us).alias("window_end"), result.alias(name))


def running_aggregate(
    df: DataFrame, *, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], state: StructType | str, lift: Callable[..., tuple],
    merge: Merge, result: Column, name: str, blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """The user aggregate of all rows of a key so far, on every row.

    `lift` turns the `columns` of one row into an accumulator. Keys with many rows are
    cut into blocks: the accumulators of the earlier blocks are merged into one, with which a
    block begins. Inside a block the rows pass as a stream, one accumulator being held.
    """
    keys, fields = list(keys), struct(state) if isinstance(state, str) else state
    names, given = fields.fieldNames(), list(columns)
    kept = [c for c in df.columns if c != BLOCK]
    cut, blocks = cut_rows(df, keys, order[0], blocks)
    by = [*keys, BLOCK] if blocks else keys
    carried = [f"_c{i}" for i in range(len(names))]
    if blocks:
        def total(rows: pd.DataFrame) -> tuple:
            return reduce(merge, (lift(*r) for r in rows[given].itertuples(index=False, name=None)))

        hot = cut.where(F.col(BLOCK) != WHOLE)
        totals = merged_states(partial_states(hot, keys=by, columns=given, state=fields, accumulate=total, merge=merge), keys=by, state=fields, merge=merge)
        schema = StructType([*[df.schema[k] for k in keys], *totals.select(BLOCK).schema.fields, *fields.fields])

        def prefixes(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            found, acc = [], None
            for r in part.sort_values(BLOCK)[[BLOCK, *names]].itertuples(index=False, name=None):
                if acc is not None:
                    found.append((*key, r[0], *acc))
                acc = r[1:] if acc is None else merge(acc, r[1:])
            return pd.DataFrame(found, columns=schema.fieldNames())

        joined = [f"_j{i}" for i in range(len(by))]
        before = totals.groupBy(*keys).applyInPandas(prefixes, schema).toDF(*joined, *carried)
        cut = cut.join(before, same_keys(by, joined), "left").drop(*joined)
    else:
        cut = cut.select("*", *[F.lit(None).cast(f.dataType).alias(c) for f, c in zip(fields.fields, carried)])
    out = StructType([*[df.schema[c] for c in kept], *fields.fields])

    def along(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = acc = None
        for batch in batches:
            if batch.empty:
                continue
            groups = batch[by].itertuples(index=False, name=None) if by else repeat(())
            starts = batch[carried].itertuples(index=False, name=None)
            found = []
            for own, start, values in zip(groups, starts, batch[given].itertuples(index=False, name=None)):
                own = tuple(None if pd.isna(k) else k for k in own)
                if group is None or own != group:
                    group, acc = own, None if any(pd.isna(x) for x in start) else tuple(start)
                acc = lift(*values) if acc is None else merge(acc, lift(*values))
                found.append(acc)
            states = pd.DataFrame(found, columns=names, index=batch.index)
            yield pd.concat([batch[kept], states], axis=1)

    dealt = cut.repartition(*[F.col(k) for k in by]) if by else cut.repartition(1)
    rows = dealt.sortWithinPartitions(*by, *order).select(*kept, *([BLOCK] if blocks else []), *carried)
    return rows.mapInPandas(along, out).select(*kept, result.alias(name))


def top_values(df: DataFrame, *, keys: Sequence[str], value: str, n: int = 2, ties: Sequence[str] = ()) -> DataFrame:
    """Table aggregate: up to `n` rows (value, 'Top1'..'TopN') per group, duplicates kept."""
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc(), *ties)
    ranked = df.select(*keys, value, *ties).withColumn("_rk", F.row_number().over(w))
    return ranked.where(F.col("_rk") <= n).select(
        *keys, F.col(value).alias("value"), F.concat(F.lit("Top"), F.col("_rk").cast("string")).alias("rank")
    )
