"""Approximate nearest neighbours by inner product: hierarchical k-means tree, best bin first.

The tree is fitted on a bounded sample (`sample_rows`), with about one leaf per LEAF_ROWS
rows, at most MAX_LEAVES; it is small and broadcast. Every row of the table is indexed: it
goes down the tree to its leaf. A query goes through the tree with a priority queue, the
node with the largest inner product with its centre (plus its spread) first, and visits
leaves until the calibrated number is reached. That number is found by widening the visits
for some queries whose true neighbours among all rows are known, until their recall is
`recall` or more.

Leaves meet their queries in shards: neighbouring leaves share one of about BLOCK rows, a leaf
with more rows is cut into several, and many queries are cut into parts too. A group is one
shard with one part; it multiplies each leaf with the queries that visit it, and only the best
`k` rows of a query leave the shard. What comes close to the last place is summed again product
by product, so equal vectors have equal scores.

Defined cases: vectors that are null, zero, of another length than the most frequent one, or
hold null or non-finite components take no part, nor do rows with a null id. Equal scores go
to the smaller id. A row's own id is no candidate. Of repeated query ids the smallest vector
is the query; repeated candidate rows all count. No query or no candidate gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from weirstone.llm.common import col, saved

SAMPLE_ROWS = 20_000
LEAF_ROWS = 512
MAX_LEAVES = 2048
BRANCHES = 8
ROUNDS = 8
BLOCK = 8192
CALIBRATE = 100
RECALL = 0.95
SPREAD = 1.0
SCORES = "query_id long, vec_id long, score double"


@dataclass
class Tree:
    """Nodes as rows: centre, spread, children (empty for a leaf), leaf number."""

    centres: np.ndarray
    spreads: np.ndarray
    children: list[list[int]]
    leaf: list[int]

    @property
    def leaves(self) -> int:
        return sum(not c for c in self.children)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row, going to the nearest child at each node."""
        found = np.zeros(len(x), dtype=np.int32)
        work = [(0, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            if not self.children[node]:
                found[rows] = self.leaf[node]
            elif len(rows):
                below = np.array(self.children[node])
                near = nearest(x[rows], self.centres[below])
                work += [(int(c), rows[near == i]) for i, c in enumerate(below)]
        return found

    def visits(self, queries: np.ndarray, count: int) -> list[list[int]]:
        """The first `count` leaves of each query, best bin first."""
        promise = queries @ self.centres.T + SPREAD * np.linalg.norm(queries, axis=1)[:, None] * self.spreads
        found = []
        for row in promise:
            heap, seen = [(-row[0], 0)], []
            while heap and len(seen) < count:
                _, node = heapq.heappop(heap)
                if self.children[node]:
                    for c in self.children[node]:
                        heapq.heappush(heap, (-row[c], c))
                else:
                    seen.append(self.leaf[node])
            found.append(seen)
        return found


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centres.T - 0.5 * (centres * centres).sum(axis=1), axis=1)


def split(x: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
    """Row numbers of up to BRANCHES clusters; one if the rows can't be told apart."""
    centres = x[rng.choice(len(x), min(BRANCHES, len(x)), replace=False)]
    for _ in range(ROUNDS):
        near = nearest(x, centres)
        centres = np.stack([x[near == i].mean(axis=0) for i in np.unique(near)])
    near = nearest(x, centres)
    return [np.flatnonzero(near == i) for i in np.unique(near)]


def grow(x: np.ndarray, leaves: int, seed: int = 11) -> Tree:
    """A tree with about `leaves` leaves: the fullest leaf is split next."""
    rng = np.random.default_rng(seed)
    centres, children, rows = [x.mean(axis=0)], [[]], [np.arange(len(x))]
    heap, n = [(-len(x), 0)], 1
    while heap and n < leaves:
        size, node = heapq.heappop(heap)
        if -size < 2 * BRANCHES:
            break
        parts = split(x[rows[node]], rng)
        if len(parts) < 2:
            continue
        for part in parts:
            own = rows[node][part]
            children[node].append(len(centres))
            centres.append(x[own].mean(axis=0))
            children.append([])
            rows.append(own)
            heapq.heappush(heap, (-len(own), len(centres) - 1))
        n += len(parts) - 1
    spreads = np.array([np.sqrt(((x[r] - c) ** 2).sum(axis=1).mean()) for r, c in zip(rows, centres)])
    number, leaf = 0, []
    for below in children:
        leaf.append(-1 if below else number)
        number += not below
    return Tree(np.stack(centres), spreads, children, leaf)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column as rows of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def best(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, positions, scores) of each query's `k` best rows among these, ties to the smaller id."""
    if not len(ids):
        return
    length = np.linalg.norm(x, axis=1).max()
    for at in range(0, len(queries), 256):
        few, own = queries[at : at + 256], query_ids[at : at + 256]
        rough = few @ x.T
        rough[ids[None, :] == own[:, None]] = -np.inf
        kth = np.partition(rough, -k, axis=1)[:, -k] if rough.shape[1] > k else np.full(len(few), -np.inf)
        slack = 1e-10 * length * np.linalg.norm(few, axis=1)
        for q, vector, row, least in zip(own.tolist(), few, rough, kth - slack):
            near = np.flatnonzero((row >= least) & (row > -np.inf))
            scores = (x[near] * vector).sum(axis=1)
            order = np.lexsort((ids[near], -scores))[:k]
            yield q, near[order], scores[order]


def taking_part(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that can be compared, vectors as arrays of doubles."""
    rows = df.select(col(vec_id).cast("long").alias("vec_id"), col(vector).cast("array<double>").alias("vector")).where("vec_id IS NOT NULL")
    sound = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists("vector", lambda x: x != 0)
    rows = rows.where(sound)
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("vector") == (common["d"] if common else 0))


def top(scores: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def shards_of(counts: list[tuple[int, int]]) -> dict[int, list[int]]:
    """Shards of each leaf: neighbouring leaves share one of about BLOCK rows, a larger leaf has several of its own."""
    found, shard, room = {}, -1, 0
    for leaf, n in counts:
        parts = -(-n // BLOCK)
        if parts > 1 or n > room:
            shard, room = shard + 1, BLOCK
        found[leaf] = list(range(shard, shard + parts))
        shard, room = shard + parts - 1, room - n if parts == 1 else 0
    return found


def search(
    df: DataFrame, is_query: Column, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20, recall: float = RECALL,
    sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` best rows found for every row for which `is_query` (over `vec_id`) holds."""
    spark = df.sparkSession
    rows = taking_part(df, vec_id, vector)
    by_hash = [F.xxhash64("vec_id"), F.col("vec_id"), F.col("vector")]
    n = rows.count()
    sample = rows.orderBy(*by_hash).limit(sample_rows).toArrow()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = spark.sparkContext.broadcast(grow(matrix(sample.column("vector")), max(1, min(MAX_LEAVES, n // leaf_rows))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.value.assign(matrix(batch.column(1))) if batch.num_rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(leaf), batch.column(1)], names=["vec_id", "leaf", "vector"])

    index = saved(rows.mapInArrow(place, "vec_id long, leaf int, vector array<double>"), "index")
    queries = index.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))

    # Calibration: the true neighbours of some queries, and the leaves that hold them.
    some = queries.orderBy(*by_hash).limit(CALIBRATE).toArrow()
    if not some.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = (some.column("vec_id").to_numpy(), matrix(some.column("vector")))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, leaf = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            found = list(best(ids, matrix(batch.column(2)) if batch.num_rows else np.zeros((0, 1)), *asked, k))
            if found:
                q = np.concatenate([np.full(len(p), i) for i, p, _ in found])
                at = np.concatenate([p for _, p, _ in found])
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids[at]), pa.array(np.concatenate([s for *_, s in found])), pa.array(leaf[at])], names=["query_id", "vec_id", "score", "leaf"])

    truth = top(index.mapInArrow(exact, SCORES + ", leaf int"), k).select("query_id", "leaf").collect()
    order = {q: {leaf: i for i, leaf in enumerate(seen)} for q, seen in zip(asked[0].tolist(), tree.value.visits(asked[1], tree.value.leaves))}
    reached = np.sort([order[r["query_id"]][r["leaf"]] for r in truth])
    visits = 1
    while len(reached) and (reached < visits).mean() < recall:
        visits += 1

    counts = sorted((r["leaf"], r["count"]) for r in index.groupBy("leaf").count().collect())  # a row per leaf at most
    shards = shards_of(counts)
    query_parts = max(1, -(-queries.count() // (4 * BLOCK)))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                few, owner, shard, leaves = batch.slice(at, 1024), [], [], []
                for i, seen in enumerate(tree.value.visits(matrix(few.column(1)), visits)):
                    met: dict[int, list[int]] = {}
                    for leaf in seen:
                        for s in shards.get(leaf, ()):
                            met.setdefault(s, []).append(leaf)
                    owner += [i] * len(met)
                    shard += met.keys()
                    leaves += met.values()
                at_ = pa.array(owner, pa.int64())
                columns = [few.column(0).take(at_), pa.array(shard, pa.int32()), pa.array(leaves, pa.list_(pa.int32())), few.column(1).take(at_)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "shard", "leaves", "vector"])

    met = queries.mapInArrow(walk, "query_id long, shard int, leaves array<int>, vector array<double>")
    met = met.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(query_parts)).cast("int"))
    firsts = F.broadcast(spark.createDataFrame([(leaf, s[0], len(s)) for leaf, s in shards.items()], "leaf int, first int, n int"))
    own = index.join(firsts, "leaf").withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("n"))).cast("int"))
    own = own.select("shard", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))).alias("part"), "vec_id", "leaf", "vector")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        if left.num_rows and right.num_rows:
            ids, leaf, x = left.column("vec_id").to_numpy(), left.column("leaf").to_numpy(), matrix(left.column("vector"))
            asked_ids, q = right.column("query_id").to_numpy(), matrix(right.column("vector"))
            visitors: dict[int, list[int]] = {}
            for i, seen in enumerate(right.column("leaves").to_pylist()):
                for one in seen:
                    visitors.setdefault(one, []).append(i)
            for one, rows_ in visitors.items():
                at = np.flatnonzero(leaf == one)
                for query, near, scores in best(ids[at], x[at], asked_ids[rows_], q[rows_], k):
                    held.setdefault(query, []).append((ids[at][near], scores))
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        for query, parts in held.items():
            found, scores = (np.concatenate(p) for p in zip(*parts))
            order = np.lexsort((found, -scores))[:k]
            for column, values in zip(out, (np.full(len(order), query), found[order], scores[order])):
                column.append(values)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, out))))

    scores = own.groupBy("shard", "part").cogroup(met.groupBy("shard", "part")).applyInArrow(compare, SCORES)
    return top(scores, k).select("query_id", "rank", "vec_id", "score")
