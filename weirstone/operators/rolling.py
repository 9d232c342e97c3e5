"""Keyed rolling operators: one output row per input row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirstone.operators.running import (
    BLOCK,
    DEFAULT_BLOCKS,
    WHOLE,
    Blocks,
    Fold,
    cut_rows,
    same_keys,
    first_value,
    numbered,
    previous,
    running,
    running_count,
    running_max,
    running_sum,
)


def rolling_sum(df, *, keys, order, value: str, name: str = "total", blocks=DEFAULT_BLOCKS) -> DataFrame:
    return running(df, keys=keys, order=order, folds={name: running_sum(F.col(value))}, blocks=blocks)


def rolling_max(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    keep: Sequence[str],
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """Running maximum of `value`; the `keep` fields stay those of the key's first row."""
    folds: dict[str, Fold] = {f"first_{c}": first_value(F.col(c)) for c in keep}
    folds[f"max_{value}"] = running_max(F.col(value))
    return running(df, keys=keys, order=order, folds=folds, blocks=blocks)


def rolling_max_by(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    keep: Sequence[str],
    newest_on_tie: bool = True,
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """Running row with the largest `value`, as columns `best_*`.

    `order` has to be numeric when the older row wins ties.
    """
    tie = [F.col(c) if newest_on_tie else -F.col(c) for c in order]
    best = F.struct(
        F.col(value).alias("v"),
        F.struct(*[t.alias(f"o{i}") for i, t in enumerate(tie)]).alias("o"),
        F.struct(*keep).alias("row"),
    )
    out = running(df, keys=keys, order=order, folds={"_best": running_max(best)}, blocks=blocks)
    return out.select(
        "*",
        F.col("_best.v").alias(f"best_{value}"),
        *[F.col(f"_best.row.{c}").alias(f"best_{c}") for c in keep],
    ).drop("_best")


def rolling_reduce(
    df: DataFrame, *, keys, order, folds: dict[str, Fold], blocks: Blocks | None = DEFAULT_BLOCKS
) -> DataFrame:
    """(accumulated, row) -> row with a fold per field, emitted at each step.

    An arbitrary, order-dependent reducer is `streaming.processors.Reduce`.
    """
    return running(df, keys=keys, order=order, folds=folds, blocks=blocks)


def rolling_average(df, *, keys, order, value: str, name: str = "mean", blocks=DEFAULT_BLOCKS) -> DataFrame:
    out = running(
        df,
        keys=keys,
        order=order,
        folds={"_sum": running_sum(F.col(value)), "_cnt": running_count()},
        blocks=blocks,
    )
    return out.withColumn(name, F.col("_sum") / F.col("_cnt")).drop("_sum", "_cnt")


def changelog_count(
    df: DataFrame, *, keys: Sequence[str], order: Sequence[str], blocks: Blocks | None = DEFAULT_BLOCKS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Changelog of a count: each row retracts the old value and adds the new one.

    Columns: keys, step (the arrival number), added (False = retraction), ct. `counted`
    (keys, n) tells how many rows of a key came before these, in a stream's earlier batches.
    """
    rows = numbered(df, keys=keys, order=order, name="step", blocks=blocks)
    if counted is not None:
        names = [f"_k{i}" for i in range(len(keys))]
        known = counted.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("n").alias("_before"))
        rows = rows.join(known, same_keys(keys, names), "left").withColumn("step", F.col("step") + F.coalesce("_before", F.lit(0)))
    new = F.struct(F.lit(True).alias("added"), F.col("step").alias("ct"))
    old = F.struct(F.lit(False).alias("added"), (F.col("step") - 1).alias("ct"))
    pair = F.when(F.col("step") == 1, F.array(new)).otherwise(F.array(old, new))
    return rows.select(*keys, "step", F.explode(pair).alias("c")).select(*keys, "step", "c.*")


def first_per_key(df: DataFrame, *, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The earliest row of each key; map-side combined, so a hot key is no issue."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return first.select(*keys, "r.*").select(*df.columns)


def last_per_key(df: DataFrame, *, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest row of each key: what an upsert sink has to store."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return last.select(*keys, "r.*").select(*df.columns)


def running_distinct(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    value: str,
    order: Sequence[str],
    name: str = "uv",
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """New distinct count each time an unseen `value` arrives."""
    seen = first_per_key(df.select(*keys, value, *order), keys=[*keys, value], order=order)
    return numbered(seen, keys=keys, order=order, name=name, blocks=blocks)


def _top_frames(df: DataFrame, w, item: Column, n: int, prefix: str) -> DataFrame:
    """Columns prefix1..n: the n largest items so far, by a chain of running maxima.

    What a new item pushes out of place i competes for place i + 1.
    """
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("_in", item)
    for i in range(1, n + 1):
        out = out.withColumn("_held", F.max("_in").over(before))
        out = out.withColumn(f"{prefix}{i}", F.greatest("_held", "_in")).withColumn(
            "_in",
            F.when(F.col("_held").isNotNull() & F.col("_in").isNotNull(), F.least("_held", "_in")),
        )
    return out.drop("_in", "_held")


def running_top(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    n: int = 3,
    name: str = "top",
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """List of the key's `n` largest values so far, on every row, largest first.

    `order[0]` has to be a numeric arrival column; the older row goes first on ties.
    """
    keys = list(keys)
    item = F.struct(F.col(value).alias("v"), (-F.col(order[0])).alias("o"))
    cut, blocks = cut_rows(df, keys, order[0], blocks)
    tops = [f"_top{i}" for i in range(1, n + 1)]
    if blocks is None:
        merged = _top_frames(cut, Window.partitionBy(*keys).orderBy(*order), item, n, "_top")
        pool = F.array_compact(F.array(*tops))
        return merged.select(*df.columns, F.transform(pool, lambda t: t["v"]).alias(name))
    in_block = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    local = _top_frames(cut, in_block, item, n, "_top")
    # Block totals: its n best items, found with a per-task limit before the shuffle.
    best_first = Window.partitionBy(*keys, BLOCK).orderBy(F.col("_item").desc())
    best = (
        cut.where(F.col(BLOCK) != WHOLE)
        .select(*keys, BLOCK, item.alias("_item"))
        .withColumn("_rk", F.row_number().over(best_first))
        .where(F.col("_rk") <= n)
    )
    along = Window.partitionBy(*keys).orderBy(BLOCK, "_rk")
    chained = _top_frames(best, along, F.col("_item"), n, "_c")
    per_block = chained.groupBy(*keys, BLOCK).agg(
        F.max_by(F.struct(*[f"_c{i}" for i in range(1, n + 1)]), "_rk").alias("_upto")
    )
    carried = per_block.select(
        *keys, BLOCK, F.lag("_upto").over(Window.partitionBy(*keys).orderBy(BLOCK)).alias("_c")
    )
    names = [f"_j{i}" for i in range(len(keys))]
    carried = carried.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(BLOCK).alias("_jb"), "_c")
    merged = local.join(carried, same_keys(keys, names) & (F.col(BLOCK) == F.col("_jb")), "left")
    pool = F.array_compact(F.array(*tops, *[F.col(f"_c._c{i}") for i in range(1, n + 1)]))
    top = F.slice(F.sort_array(pool, asc=False), 1, n)
    return merged.select(*df.columns, F.transform(top, lambda t: t["v"]).alias(name))


def top_changelog(
    df: DataFrame, *, keys: Sequence[str], order: Sequence[str], value: str, n: int = 2, blocks: Blocks | None = DEFAULT_BLOCKS
) -> DataFrame:
    """Changelog of a key's `n` largest values: (keys, step, rank, added, value), ranks from 1.

    A row that changes the list retracts the value of each rank that moved (`added` False)
    and adds the new one; `step` is its arrival number `order[0]`. Ranks without change put
    out nothing.
    """
    # Cut once for both passes: cutting again would make the lists once more to count them, and once for the bounds.
    cut, blocks = cut_rows(df, keys, order[0], blocks)
    listed = running_top(cut, keys=keys, order=order, value=value, n=n, name="_top", blocks=blocks)
    both = running(listed, keys=keys, order=order, folds={"_held": previous(F.col("_top"))}, blocks=blocks)

    def moves(i: int) -> Column:
        old, new = F.get("_held", F.lit(i)), F.get("_top", F.lit(i))
        pair = [F.struct(F.lit(i + 1).alias("rank"), F.lit(added).alias("added"), x.alias("value")) for added, x in ((False, old), (True, new))]
        moved = F.filter(F.array(*pair), lambda m: m["value"].isNotNull())
        return F.when(old.eqNullSafe(new), F.slice(moved, 1, 0)).otherwise(moved)

    out = both.select(*keys, F.col(order[0]).alias("step"), F.explode(F.concat(*map(moves, range(n)))).alias("m"))
    return out.select(*keys, "step", "m.rank", "m.added", "m.value")
