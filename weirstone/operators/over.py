"""OVER windows and top-N."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirstone.operators.running import DEFAULT_BLOCKS, Blocks, Fold, running, trailing_rows


def over_unbounded(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    order: Sequence[str],
    folds: dict[str, Fold],
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """All rows so far, rows of equal order being peers (RANGE frame).

    Without keys the order is global; the blocks still spread it over the cluster.
    """
    return running(df, keys=keys, order=order, folds=folds, blocks=blocks, peers=True)


def over_rows(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    preceding: int,
    aggs: dict[str, Column],
    blocks: Blocks | None = DEFAULT_BLOCKS,
) -> DataFrame:
    """ROWS BETWEEN n PRECEDING AND CURRENT ROW."""
    return trailing_rows(
        df, keys=keys, order=order, preceding=preceding, aggs=aggs, number="_n", blocks=blocks
    ).drop("_n")


def top_n(
    df: DataFrame, *, keys: Sequence[str], by: str, ties: Sequence[str], n: int, rank: str = "rk"
) -> DataFrame:
    """The `n` largest rows per group; the smaller tie column wins.

    Spark limits each task to `n` rows per group before the shuffle
    (WindowGroupLimit), so a large group does not reach one task whole.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(by).desc(), *[F.col(t).asc() for t in ties])
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def top_n_batches(
    write: Callable[[DataFrame, int], None],
    *,
    keys: Sequence[str],
    by: str,
    ties: Sequence[str],
    n: int,
) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function for top-N over a stream of closed window counts.

    Ranking is not allowed on a stream. In append mode all counts of a window come
    out in the same micro-batch, so ranking the batch is exact, and no window's
    counts are gathered in one task.
    """

    def rank(batch: DataFrame, batch_id: int) -> None:
        write(top_n(batch, keys=keys, by=by, ties=ties, n=n), batch_id)

    return rank
