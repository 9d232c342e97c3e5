"""Vector code compression: each part of a vector becomes the index of its nearest codebook entry.

Components are taken as integers floor(256 * x), and a vector is cut into `parts` equal
parts, each with a codebook of its own. The codebooks start as the vectors with the
`entries` smallest ids and follow `rounds` of Lloyd's steps in integers: every part goes to
its nearest entry (squared Euclidean distance, ties to the lower index), and an entry becomes
the componentwise floor of the mean of its parts; an entry without parts stays.

The nearest entry is looked up in memoised grid cells. A part's coarse cell is hashed; for a
cell seen the first time the least and the greatest distance of every entry to the cell's box
are computed, and only entries whose least distance does not exceed the smallest greatest
one are remembered: the others are farther from every point of the box. A part is then
compared exactly with the entries of its cell. Cells are remembered per task and part, up to
MEMO; a hash shared by two cells is noticed by the cell's own coordinates, and such parts are
compared with all entries.

A round reads the rows once, adds up per task, and brings one row per entry and component to
the driver: as many as a codebook has numbers, whatever the table's size.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor
do those of another length than the most frequent one (of equally frequent ones the longest).
A length that `parts` does not divide is filled up with zeros. A null id counts as the
largest; of repeated ids the smallest vector starts an entry, and repeated rows all count.
With fewer ids than `entries` the codebooks are smaller. Components of LIMIT or more in size
raise an error, since distances would leave 64 bits. An empty table has no codes and empty
codebooks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from weirstone.llm.common import col, fresh, mapped, saved

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
# Of a component; 2^24 after scaling, so differences of up to 2^25, squared and summed over LONGEST components, stay below 2^63.
LIMIT = float(1 << 16)
LONGEST = 4096
MEMO = 1 << 14
CHUNK = 1 << 14


@dataclass
class Codebooks:
    """`entries[part]` is a matrix of integers, one entry a row; `length` is that of the vectors."""

    entries: np.ndarray
    length: int

    def listed(self) -> str:
        """All integers by part, entry and position."""
        return ",".join(map(str, self.entries.reshape(-1).tolist()))


class Cells:
    """The grid of one part's codebook and what is remembered of its cells."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        # A cell is about as wide as the entries are apart from their mean; any width gives the same result.
        self.width = max(1, int(np.sqrt(entries.var(axis=0).mean()))) if entries.size else 1
        rng = np.random.default_rng(5)
        self.mix = rng.integers(1 << 62, size=entries.shape[1], dtype=np.int64) | 1
        self.forget()

    def forget(self) -> None:
        m = self.entries.shape[1]
        self.keys, self.cells = np.empty(0, np.int64), np.empty((0, m), np.int64)
        self.counts, self.order = np.empty(0, np.int64), np.empty((0, len(self.entries)), np.int16)

    def candidates(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many entries stay for each cell, and their indexes in ascending order, before the others."""
        counts, order = [], []
        for at in range(0, len(cells), 1024):
            low = (cells[at : at + 1024] * self.width)[:, None, :]
            high = low + self.width - 1
            under, over = low - self.entries[None], self.entries[None] - high
            gap = np.maximum(np.maximum(under, over), 0)
            reach = np.maximum(np.abs(under), np.abs(over))
            least, greatest = (gap * gap).sum(axis=2), (reach * reach).sum(axis=2)
            out = least > greatest.min(axis=1)[:, None]
            counts.append((~out).sum(axis=1))
            order.append(np.argsort(out, axis=1, kind="stable").astype(np.int16))
        return np.concatenate(counts), np.concatenate(order)

    def learn(self, keys: np.ndarray, cells: np.ndarray) -> None:
        if len(self.keys) + len(keys) > MEMO:
            self.forget()
        counts, order = self.candidates(cells)
        keys = np.concatenate([self.keys, keys])
        by = np.argsort(keys, kind="stable")
        self.keys, self.cells = keys[by], np.concatenate([self.cells, cells])[by]
        self.counts, self.order = np.concatenate([self.counts, counts])[by], np.concatenate([self.order, order])[by]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of every row, and the squared distance."""
        cells = np.floor_divide(x, self.width)
        keys = (cells * self.mix).sum(axis=1)
        found, first = np.unique(keys, return_index=True)
        place = np.searchsorted(self.keys, found)
        new = place == len(self.keys)
        new[~new] = self.keys[place[~new]] != found[~new]
        if new.any():
            if len(self.keys) + new.sum() > MEMO:  # all are forgotten, so all are new
                new[:] = True
            self.learn(found[new], cells[first[new]])
        slot = np.searchsorted(self.keys, keys)
        clash = (self.cells[slot] != cells).any(axis=1)
        count = np.where(clash, len(self.entries), self.counts[slot])
        index, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
        by = np.argsort(count, kind="stable")
        for at in range(0, len(x), 4096):
            rows = by[at : at + 4096]
            k = int(count[rows[-1]])
            tried = self.order[slot[rows], :k].astype(np.int64)
            tried[clash[rows]] = np.arange(k)
            off = self.entries[tried] - x[rows][:, None, :]
            squares = (off * off).sum(axis=2)
            squares[np.arange(k) >= count[rows][:, None]] = np.iinfo(np.int64).max
            best = squares.argmin(axis=1)
            index[rows], distance[rows] = tried[np.arange(len(rows)), best], squares[np.arange(len(rows)), best]
        return index, distance


def grids(books: np.ndarray) -> list[Cells]:
    return [Cells(entries) for entries in books]


def assigned(x: np.ndarray, cells: list[Cells]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and squared distances, a column per part, of rows of integers."""
    parts = x.reshape(len(x), len(cells), -1)
    found = [own.nearest(parts[:, p]) for p, own in enumerate(cells)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, length)


def integers(column: pa.Array, parts: int) -> tuple[list[np.ndarray | None], list[int]]:
    """Each vector as integers, filled up with zeros, or None; and its own length."""
    known = column.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(known, np.diff(column.offsets.to_numpy()), 0)
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    bad = ~np.isfinite(values) | flat.is_null().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    n_bad = np.concatenate([[0], np.cumsum(bad)])
    found: list[np.ndarray | None] = []
    for sound, a, b in zip(known.tolist(), (ends - lengths).tolist(), ends.tolist()):
        if not sound or n_bad[b] > n_bad[a]:
            found.append(None)
            continue
        own = values[a:b]
        if len(own) > LONGEST or (np.abs(own) >= LIMIT).any():
            raise ValueError(f"vectors must have at most {LONGEST} components, each below {LIMIT} in size")
        found.append(np.concatenate([np.floor(own * SCALE), np.zeros(-len(own) % parts)]).astype(np.int32))
    return found, lengths.tolist()


def prepared(df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", parts: int = PARTS, keep: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(vec_id, `keep`, length, v) of the rows that take part, written to a table, and the common length; v is the vector as integers."""
    slim = df.select(col(vec_id).alias("vec_id"), *map(col, keep), col(vector).cast("array<double>"))
    schema = StructType([*slim.schema.fields[:-1], StructField("length", IntegerType()), StructField("v", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, lengths = integers(batch.column(batch.num_columns - 1), parts)
            sound = pa.array([f is not None for f in found])
            columns = [*batch.columns[:-1], pa.array(lengths, pa.int32()), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames()).filter(sound)

    rows = saved(mapped(slim, run, schema), "vectors")
    common = rows.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    length = common["length"] if common else 0
    return rows.where(F.col("length") == length), length


def first_entries(rows: DataFrame, length: int, parts: int, entries: int) -> np.ndarray:
    """The vectors with the smallest ids, as codebooks (part, entry, component)."""
    ids = rows.select(F.col("vec_id").alias("id")).distinct().orderBy(F.col("id").asc_nulls_last()).limit(entries)
    taken = rows.join(F.broadcast(ids), F.col("vec_id").eqNullSafe(F.col("id"))).groupBy("vec_id").agg(F.min("v").alias("v"))
    vectors = [r["v"] for r in taken.orderBy(F.col("vec_id").asc_nulls_last()).collect()]
    size = -(-length // parts)
    return np.array(vectors, np.int64).reshape(len(vectors), parts, size).transpose(1, 0, 2)


def step(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: the codebooks after every part has gone to its nearest entry."""
    sent = rows.sparkSession.sparkContext.broadcast(books)
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = grids(sent.value)
        sums, counts = np.zeros((parts, entries, size), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = matrix(batch.column(0), parts * size)
            for at in range(0, len(x), CHUNK):
                own = x[at : at + CHUNK]
                index, _ = assigned(own, cells)
                for p in range(parts):
                    counts[p] += np.bincount(index[:, p], minlength=entries)
                    for j in range(size):
                        # Exact: a chunk's sum stays below 2^53.
                        sums[p, :, j] += np.bincount(index[:, p], own[:, p * size + j], entries).astype(np.int64)
        for p in range(parts):
            used = np.flatnonzero(counts[p])
            columns = [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(counts[p, used]), pa.array(list(sums[p, used]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    found = rows.select("v").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    total = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(size)])
    moved = books.copy()
    for r in total.collect():
        moved[r["part"], r["entry"]] = [r[f"s{j}"] // r["n"] for j in range(size)]
    return moved


def train(rows: DataFrame, length: int, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of `prepared` rows."""
    books = first_entries(rows, length, parts, entries)
    for _ in range(rounds if books.shape[1] else 0):
        books = step(rows, books)
    return Codebooks(books, length)


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """`prepared` rows with `code` (an index per part) and `error` (squared distances, summed) in place of the vector."""
    sent = rows.sparkSession.sparkContext.broadcast(books.entries)
    parts, entries, size = books.entries.shape
    slim = rows.drop("length")
    place = slim.columns.index("v")
    schema = StructType([*[f for f in slim.schema.fields if f.name != "v"], StructField("code", ArrayType(IntegerType())), StructField("error", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = grids(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                index, squares = assigned(matrix(part.column(place), parts * size), cells)
                code = pa.ListArray.from_arrays(pa.array(np.arange(len(index) + 1, dtype=np.int32) * parts), pa.array(index.astype(np.int32).reshape(-1)))
                others = [c for i, c in enumerate(part.columns) if i != place]
                yield pa.RecordBatch.from_arrays([*others, code, pa.array(squares.sum(axis=1))], names=schema.fieldNames())

    return mapped(slim, run, schema)


def decode(coded: DataFrame, books: Codebooks, *, code: str = "code", out: str = "vector") -> DataFrame:
    """`coded` with the column `out`: the vector that a code stands for, components at the middle of their integer's range."""
    sent = coded.sparkSession.sparkContext.broadcast(books.entries)
    length, place = books.length, coded.columns.index(code)
    schema = StructType([*coded.schema.fields, StructField(out, ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = sent.value
        every = np.arange(len(entries))
        for batch in batches:
            known = [None if c is None else ((entries[every, c].reshape(-1)[:length] + 0.5) / SCALE).tolist() for c in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(known, pa.list_(pa.float64()))], names=schema.fieldNames())

    return mapped(coded, run, schema)


# Up to so many labels their sums are sent to every task; beyond, rows and sums meet in SALTS parts of a label.
BROADCAST_LABELS, SALTS = 1_000_000, 32


def with_group_error(coded: DataFrame, label: str, out: str) -> DataFrame:
    """`coded` with the column `out`: `error` summed over the rows with an equal label, nulls together."""
    coded = saved(coded, "codes")
    same, salt = fresh([*coded.columns, out], "same", "salt")
    sums = saved(coded.groupBy(col(label).alias(same)).agg(F.sum("error").alias(out)), "errors")
    if sums.count() <= BROADCAST_LABELS:
        return coded.join(F.broadcast(sums), col(label).eqNullSafe(col(same))).drop(same)
    spread = sums.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = coded.withColumn(salt, F.pmod(F.xxhash64(*map(col, coded.columns)), F.lit(SALTS)).cast("int"))
    return dealt.join(spread, [salt]).where(col(label).eqNullSafe(col(same))).select(*map(col, coded.columns), col(out))


def compressed(
    df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error, label_error) of every row that takes part, and the codebooks."""
    slim = df.select(col(vec_id).alias("vec_id"), col(label).alias("label"), col(vector).alias("vector"))
    rows, length = prepared(slim, vector="vector", parts=parts, keep=("label",))
    books = train(rows, length, parts=parts, entries=entries, rounds=rounds)
    return with_group_error(encode(rows, books), "label", "label_error"), books


def hex_code(code: Column) -> Column:
    """Two hex digits per part, lowercase."""
    return F.array_join(F.transform(code, lambda i: F.lower(F.lpad(F.hex(i), 2, "0"))), "")
