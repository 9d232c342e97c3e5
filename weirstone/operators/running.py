"""Running (rolling) values per key without putting a hot key into one task.

A plain `Window.partitionBy(key).orderBy(seq)` sorts every row of a key in one
task, so a key holding a third of the data decides the run time. Here the rows of
the keys are counted first, in one pass. Without a key of more rows than one task
should sort (`Blocks.rows`) the plain window is planned. With such keys, only their
rows are cut into blocks of the order column, each key by quantiles of its own rows:
the window runs inside (key, block), one total per (key, block) is folded over the
earlier blocks, and the carried value is joined back:

    rows ----exchange(key, block)--> window ----------------+--> join --> merge
    hot rows --partial agg--exchange--> totals --> prefix --+

The rows are shuffled once; the totals are map-side combined and a key has no more
of them than there are blocks. The hot keys, their bounds and the carry side are
DataFrames joined without a hint: Spark broadcasts them only below its own size
threshold. Up to `LISTED` hot keys and their bounds are local tables of known size, so their
rows are cut where they are read. The carry side is written to the shared scratch folder: of
known size too, it meets the windows' rows without their being dealt out and sorted again.

Bounds only balance the work; any give the same result. A null in a key column is a
key like any other; a null in the order column comes first, as Spark sorts it.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from weirstone.functions.timecols import epoch_micros
from weirstone.session import scratch

BLOCK = "_blk"
STRINGS = ("string", "varchar", "char")

# Block of every row whose key is not hot.
WHOLE = -1

# Quantiles of a hot key, a power of two; each cell between two is cut evenly.
CELLS = 64
ACCURACY = 1000
# Hot keys up to this number become a local table instead of a second pass over the counts.
LISTED = 1000


@dataclass(frozen=True)
class Blocks:
    """About `rows` rows a block, some `limit` blocks a key at most; keys of up to `rows` rows stay whole."""

    rows: int = 1 << 20
    limit: int = 1 << 16


DEFAULT_BLOCKS = Blocks()


def shared_bytes(df: DataFrame, name: str) -> int:
    """How many bytes all values of a string column begin with: what the least and the greatest share. 0 for other types."""
    if df.schema[name].dataType.typeName() not in STRINGS:
        return 0
    ends = df.agg(F.min(name), F.max(name)).first()
    return 0 if ends[0] is None else len(os.path.commonprefix([x.encode() for x in ends]))


def order_number(df: DataFrame, name: str, skip: int = 0) -> Column:
    """A double that never falls as the column grows; null stays null. TypeError for types without such a number.

    Of strings the six bytes after the first `skip`, which all have to share.
    """
    kind = df.schema[name].dataType
    if kind.typeName() in ("timestamp", "timestamp_ntz"):
        return epoch_micros(name).cast("double")
    if kind.typeName() == "date":
        return F.unix_date(name).cast("double")
    if isinstance(kind, NumericType):
        return F.col(name).cast("double")
    if kind.typeName() == "boolean":
        return F.col(name).cast("int").cast("double")
    if kind.typeName() in STRINGS:
        # Spark compares strings by their bytes.
        head = F.hex(F.substring(F.col(name).cast("binary"), skip + 1, 6))
        return F.conv(F.rpad(head, 12, "0"), 16, 10).cast("double")
    raise TypeError(f"rows can't be ordered by {name}: {kind.simpleString()}")


def same_keys(left: Sequence[str], right: Sequence[str], rows: DataFrame | None = None) -> Column:
    """Join condition on key columns in which null equals null; of `rows`, columns `left` that hold no null are compared plainly."""
    found = F.lit(True)
    for a, b in zip(left, right):
        plain = rows is not None and not rows.schema[a].nullable
        found = found & (F.col(a) == F.col(b) if plain else F.col(a).eqNullSafe(F.col(b)))
    return found


def _quantiles(x: Column) -> Column:
    return F.percentile_approx(F.when(~F.isnan(x), x), [i / CELLS for i in range(CELLS + 1)], ACCURACY)


def _local(df: DataFrame, rows: pa.Table) -> DataFrame:
    """The collected `rows` of `df` as a local relation: from a list of rows Spark makes one of unknown size, which is not broadcast."""
    return df.sparkSession.createDataFrame(rows, df.schema)


def _at_hand(carried: DataFrame) -> DataFrame:
    """What is carried to the blocks, written out: its size is known when the join is planned."""
    if "void" in carried.schema.simpleString():  # no file holds that type
        return carried
    target = scratch(carried.sparkSession, "carried")
    carried.write.parquet(target)
    return carried.sparkSession.read.schema(carried.schema).parquet(target)


def _parts(n: Column, blocks: Blocks) -> Column:
    """Blocks between two quantiles of a key with n rows."""
    pieces = F.least(F.ceil(n / blocks.rows), F.lit(blocks.limit))
    return F.greatest(F.ceil(pieces / CELLS), F.lit(1)).cast("long")


def _with_bounds(df: DataFrame, keys: list[str], hot: DataFrame, x: Column, blocks: Blocks, listed: bool) -> DataFrame:
    """`df` with `_parts` and `_bounds`, the blocks between two quantiles of its key, and these, where that is hot, else null.

    Of listed keys the bounds become a local table too: its size is known when the join is planned,
    which otherwise brings all rows of a key into one task before they are cut.
    """
    marked, bound = [f"_k{i}" for i in range(len(keys))], [f"_b{i}" for i in range(len(keys))]
    marks = hot.select(*[F.col(k).alias(n) for k, n in zip(keys, marked)])
    hot_rows = df.join(marks, same_keys(keys, marked, df), "left_semi")
    bounds = hot_rows.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, bound)]).agg(_parts(F.count(F.lit(1)), blocks).alias("_parts"), _quantiles(x).alias("_bounds"))
    if listed:
        bounds = _local(bounds, bounds.toArrow())
    return df.join(bounds, same_keys(keys, bound, df), "left").drop(*bound)


def _stepped(df: DataFrame, x: Column) -> DataFrame:
    """Add the block number: a non-decreasing step function of `x`, from 0 for null.

    `x` and its cell, found by halving, are columns of their own: Spark does not put them into
    an expression that uses them twice. A filter on the block stays above the `explode`, so the
    block is not found anew for it.
    """
    bounds, parts, v, cell = (F.col(c) for c in ("_bounds", "_parts", "_x", "_cell"))
    halves = F.array(*[F.lit(1 << i) for i in reversed(range(CELLS.bit_length() - 1))])
    # The last bound within the cells that is not above v.
    halved = F.aggregate(halves, F.lit(0), lambda c, step: F.when(F.get(bounds, c + step) <= v, c + step).otherwise(c))
    low, high = F.get(bounds, cell), F.get(bounds, cell + 1)
    wide = (high > low) & (high < float("inf")) & (low > float("-inf"))
    inside = F.when(F.isnan(v), parts - 1).when(wide, F.floor((v - low) / (high - low) * parts))
    inside = F.least(F.greatest(F.coalesce(inside, F.lit(0)), F.lit(0)), parts - 1)
    found = F.when(parts.isNull(), F.lit(WHOLE)).when(v.isNull(), F.lit(0)).otherwise(1 + cell * parts + inside)
    # Rows of other keys have no bounds to search.
    searched = df.withColumn("_x", F.when(parts.isNotNull(), x)).withColumn("_cell", F.when(v.isNotNull(), halved))
    return searched.select("*", F.explode(F.array(found.cast("long"))).alias(BLOCK)).drop("_parts", "_bounds", "_x", "_cell")


def cut_rows(
    df: DataFrame, keys: Sequence[str], order: str, blocks: Blocks | None = DEFAULT_BLOCKS
) -> tuple[DataFrame, Blocks | None]:
    """Add the block column if some key needs it; else return (df, None).

    Counts the rows of the keys, in one job. A frame that has the column already is
    not cut again.
    """
    if blocks is None or BLOCK in df.columns:
        return df, blocks
    keys = list(keys)
    x = order_number(df, order)  # also tells a type that cannot be cut, hot keys or not
    if not keys:
        x = order_number(df, order, shared_bytes(df, order))
        n, bounds = df.agg(F.count(F.lit(1)), _quantiles(x)).first()
        if n <= blocks.rows:
            return df, None
        known = F.array(*map(F.lit, bounds)) if bounds else F.lit(None).cast("array<double>")
        return _stepped(df.withColumns({"_parts": _parts(F.lit(n), blocks), "_bounds": known}), x), blocks
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > blocks.rows)
    first = hot.limit(LISTED + 1).toArrow()
    if not first.num_rows:
        return df, None
    x = order_number(df, order, shared_bytes(df, order))
    listed = first.num_rows <= LISTED
    if listed:
        hot = _local(hot, first)
    return _stepped(_with_bounds(df, keys, hot, x, blocks, listed), x), blocks


@dataclass(frozen=True)
class Fold:
    """An associative running value, given by its four parts."""

    local: Callable[[Window, Window], Column]  # (ordered window, running frame) -> value
    total: Callable[[Column, bool], Column]  # (order struct, reverse) -> value of a whole block
    carry: Callable[[Column, Window], Column]  # totals of the earlier blocks -> one value
    merge: Callable[[Column, Column], Column]  # (carried, local) -> result


def _last_by(value: Column, order: Column, reverse: bool) -> Column:
    return F.min_by(value, order) if reverse else F.max_by(value, order)


def _first_by(value: Column, order: Column, reverse: bool) -> Column:
    return _last_by(value, order, not reverse)


def running_count() -> Fold:
    return Fold(
        lambda o, f: F.count(F.lit(1)).over(f),
        lambda order, rev: F.count(F.lit(1)),
        lambda t, w: F.sum(t).over(w),
        lambda c, l: F.coalesce(c, F.lit(0)) + l,
    )


def running_sum(x: Column) -> Fold:
    return Fold(
        lambda o, f: F.sum(x).over(f),
        lambda order, rev: F.sum(x),
        lambda t, w: F.sum(t).over(w),
        lambda c, l: F.coalesce(c + l, c, l),
    )


def running_max(x: Column) -> Fold:
    return Fold(
        lambda o, f: F.max(x).over(f),
        lambda order, rev: F.max(x),
        lambda t, w: F.max(t).over(w),
        lambda c, l: F.greatest(c, l),
    )


def running_max_before(x: Column) -> Fold:
    """Maximum over the earlier rows only (null on the first)."""
    return Fold(
        lambda o, f: F.max(x).over(o.rowsBetween(Window.unboundedPreceding, -1)),
        lambda order, rev: F.max(x),
        lambda t, w: F.max(t).over(w),
        lambda c, l: F.greatest(c, l),
    )


def running_min(x: Column) -> Fold:
    return Fold(
        lambda o, f: F.min(x).over(f),
        lambda order, rev: F.min(x),
        lambda t, w: F.min(t).over(w),
        lambda c, l: F.least(c, l),
    )


def first_value(x: Column) -> Fold:
    """Value of the key's first row (null stays null)."""
    boxed = F.struct(x.alias("v"))
    return Fold(
        lambda o, f: F.first(boxed).over(f),
        lambda order, rev: _first_by(boxed, order, rev),
        lambda t, w: F.first(t, ignorenulls=True).over(w),
        lambda c, l: F.coalesce(c, l)["v"],
    )


def last_known(x: Column) -> Fold:
    """Latest non-null value up to and including the row."""
    return Fold(
        lambda o, f: F.last(x, ignorenulls=True).over(f),
        lambda order, rev: _last_by(x, F.when(x.isNotNull(), order), rev),
        lambda t, w: F.last(t, ignorenulls=True).over(w),
        lambda c, l: F.coalesce(l, c),
    )


def last_known_before(x: Column) -> Fold:
    """Latest non-null value among the earlier rows."""
    return Fold(
        lambda o, f: F.last(x, ignorenulls=True).over(o.rowsBetween(Window.unboundedPreceding, -1)),
        lambda order, rev: _last_by(x, F.when(x.isNotNull(), order), rev),
        lambda t, w: F.last(t, ignorenulls=True).over(w),
        lambda c, l: F.coalesce(l, c),
    )


def previous(x: Column) -> Fold:
    """Value of the row before (null on the key's first row)."""
    boxed = F.struct(x.alias("v"))
    return Fold(
        lambda o, f: F.lag(boxed).over(o),
        lambda order, rev: _last_by(boxed, order, rev),
        lambda t, w: F.last(t, ignorenulls=True).over(w),
        lambda c, l: F.coalesce(l, c)["v"],
    )


def running(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    folds: dict[str, Fold],
    blocks: Blocks | None = DEFAULT_BLOCKS,
    peers: bool = False,
    reverse: bool = False,
    keep_block: bool = False,
) -> DataFrame:
    """Add one running column per fold.

    `order` must be unique within a key unless `peers` is set; blocks are cut on
    its first column. `peers` lets rows equal in that order share a value (the SQL
    default RANGE frame). `reverse` runs from the last row backwards.

    For two passes over the same order call `cut_rows` first and hand its result to
    both, the first with `keep_block`: the second then needs no shuffle of the
    rows. Hot rows are read once more per pass for the totals, so do not stack more
    than two passes; checkpoint in between.
    """
    keys = list(keys)
    kept = [c for c in df.columns if c not in folds and c != BLOCK]
    cut, blocks = cut_rows(df, keys, order[0], blocks)
    blocked = blocks is not None
    sort = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    ordered = Window.partitionBy(*keys, *([BLOCK] if blocked else [])).orderBy(*sort)
    bounds = (Window.unboundedPreceding, Window.currentRow)
    frame = ordered.rangeBetween(*bounds) if peers else ordered.rowsBetween(*bounds)
    rank = F.struct(*[F.col(c) for c in order])

    local = cut.select("*", *[f.local(ordered, frame).alias(f"_l_{n}") for n, f in folds.items()])
    if not blocked:
        none = F.lit(None)
        return local.select(*kept, *[f.merge(none, F.col(f"_l_{n}")).alias(n) for n, f in folds.items()])
    totals = (
        cut.where(F.col(BLOCK) != WHOLE)
        .groupBy(*keys, BLOCK)
        .agg(*[f.total(rank, reverse).alias(f"_t_{n}") for n, f in folds.items()])
    )
    step = F.col(BLOCK).desc() if reverse else F.col(BLOCK).asc()
    earlier = (
        Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = totals.select(
        *keys, BLOCK, *[f.carry(F.col(f"_t_{n}"), earlier).alias(f"_c_{n}") for n, f in folds.items()]
    )
    names = [f"_j{i}" for i in range(len(keys))]
    carried = carried.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(BLOCK).alias("_jb"), *[f"_c_{n}" for n in folds])
    merged = local.join(_at_hand(carried), same_keys(keys, names, local) & (F.col(BLOCK) == F.col("_jb")), "left")
    if keep_block:
        kept.append(BLOCK)
    return merged.select(
        *kept, *[f.merge(F.col(f"_c_{n}"), F.col(f"_l_{n}")).alias(n) for n, f in folds.items()]
    )


def numbered(df: DataFrame, *, keys: Sequence[str], order: Sequence[str], name: str = "n",
             blocks: Blocks | None = DEFAULT_BLOCKS) -> DataFrame:
    """1-based arrival number of each row within its key."""
    return running(df, keys=keys, order=order, folds={name: running_count()}, blocks=blocks)


def chunked(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    preceding: int,
    number: str,
    chunk: int,
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """Rows numbered per key and placed in chunks (`_at`) of consecutive numbers.

    The last `preceding` rows of a chunk are also sent to the next one (`_own`
    false), so a frame of so many rows is complete inside one chunk and no task
    holds more than a chunk of a key.
    """
    if preceding >= chunk:
        raise ValueError("preceding must be smaller than chunk")
    rows = numbered(df, keys=keys, order=order, name=number, blocks=blocks)
    zero = F.col(number) - 1
    home = F.floor(zero / F.lit(chunk)).cast("long")
    near_end = F.pmod(zero, F.lit(chunk)) >= chunk - preceding
    placed = rows.withColumn(
        "_at", F.explode(F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    return placed.withColumn("_own", F.col("_at") == home)


def trailing_rows(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    preceding: int,
    aggs: dict[str, Column],
    number: str = "n",
    chunk: int = 1 << 16,
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """Aggregates over the row and the `preceding` rows before it, per key.

    Without hot keys this is one window; with them see `chunked`.
    """
    keys = list(keys)
    cut, blocks = cut_rows(df, keys, order[0], blocks)
    if blocks is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return cut.select(
            *df.columns,
            F.row_number().over(w).cast("long").alias(number),
            *[agg.over(w.rowsBetween(-preceding, 0)).alias(name) for name, agg in aggs.items()],
        )
    placed = chunked(
        cut, keys=keys, order=order, preceding=preceding, number=number, chunk=chunk, blocks=blocks
    )
    w = Window.partitionBy(*keys, "_at").orderBy(number).rowsBetween(-preceding, 0)
    out = placed.select("*", *[agg.over(w).alias(name) for name, agg in aggs.items()])
    return out.where("_own").drop("_at", "_own")
