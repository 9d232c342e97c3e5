"""SimHash near-duplicates found through a segment-popcount embedding.

Fingerprint: 64 bits over the XXH64 (seed 42) of every `n`-word shingle, repeats
included; a bit is 1 if set in more than half of the hashes.

Embedding: the 64 bits fall into 32 segments of two bits; a segment's bit count (0, 1
or 2) is kept as that many low ones, so the Manhattan distance of two count vectors
is the bit count of the exclusive or of two longs. Moving one bit changes the vector
by at most one, so this distance never exceeds the Hamming distance.

Grid: the segments form `groups` groups. Two vectors at distance 3 or less agree in all
but three groups, so they share the grid cell of at least one choice of `groups` - 3
groups. Every fingerprint is put once into its cell of each choice; within a cell
fingerprints are compared with those whose total bit count differs by 3 at most, first
by the Manhattan distance, then exactly. The number of groups follows the number of
fingerprints, so that a cell holds about one unrelated fingerprint at any size.

Equal fingerprints are one row in all this. A cell puts out one row per fingerprint
that it links, never its pairs; components are then joined by contraction, with each
round written to the shared folder.

Defined cases: a null or empty text has fingerprint zero and is linked like any other;
fewer than `n` words are one shingle. A null doc_id takes part; a component's id is the
smallest id that is not null, or null if there is none. Repeated rows are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from weirstone.llm.common import as_bytes, col, fresh, one_of_each, saved, slices, text_mark

SHINGLE = 3
SEED = 42
MAX_BITS = 3
SEGMENTS = 32
GROUPS = range(6, 17)
LOW = 0x5555555555555555
# Shingle hashes whose bits are unpacked at a time.
CHUNK = 1 << 15


def fingerprint(text: bytes, n: int = SHINGLE) -> int:
    """The fingerprint of one text, as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = min(n, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist())),
        dtype=np.uint64, count=len(words) - n + 1,
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    slim = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    schema = StructType([StructField("doc_id", slim.schema["doc_id"].dataType), StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                marks = np.array([fingerprint(t, n) for t in as_bytes(part.column(1))], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(marks.view(np.int64))], names=["doc_id", "fp"])

    return slim.mapInArrow(run, schema)


def long_literal(value: int) -> Column:
    """An unsigned 64-bit pattern as a long."""
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def embedding(fp: Column) -> Column:
    """Bit counts of the segments, each as that many low ones of its two bits."""
    high = F.shiftrightunsigned(fp, 1)
    some, both = fp.bitwiseOR(high).bitwiseAND(long_literal(LOW)), fp.bitwiseAND(high).bitwiseAND(long_literal(LOW))
    return some.bitwiseOR(F.shiftleft(both, 1))


def embedded(fps: np.ndarray) -> np.ndarray:
    """The same for an array of unsigned fingerprints."""
    high, low = fps >> np.uint64(1), np.uint64(LOW)
    return ((fps | high) & low) | (((fps & high) & low) << np.uint64(1))


def choices(groups: int) -> list[int]:
    """Bit masks of the segments in every choice of all but three groups."""
    parts = [sum(3 << (2 * s) for s in range(SEGMENTS) if s * groups // SEGMENTS == g) for g in range(groups)]
    return [sum(chosen) for chosen in combinations(parts, groups - MAX_BITS)]


def groups_for(n: int) -> int:
    """Least number of groups whose cells outnumber `n` fingerprints; a segment count holds 1.5 bits."""
    return next((g for g in GROUPS if 2 ** (1.5 * SEGMENTS * (g - MAX_BITS) / g) >= 8 * n), GROUPS[-1])


def cell_links(fps: np.ndarray) -> list[tuple[int, int]]:
    """(first, other) for all fingerprints of a cell that are connected by links within it."""
    weight = np.bitwise_count(fps)
    order = np.lexsort((fps, weight))
    fps, weight, code = fps[order], weight[order].astype(np.int64), embedded(fps[order])
    free, found = np.ones(len(fps), dtype=bool), []
    for start in range(len(fps)):
        if not free[start]:
            continue
        free[start] = False
        members, at = [start], 0
        while at < len(members):
            i = members[at]
            at += 1
            lo, hi = np.searchsorted(weight, [weight[i] - MAX_BITS, weight[i] + MAX_BITS + 1])
            near = np.flatnonzero(free[lo:hi]) + lo
            near = near[np.bitwise_count(code[near] ^ code[i]) <= MAX_BITS]
            near = near[np.bitwise_count(fps[near] ^ fps[i]) <= MAX_BITS]
            free[near] = False
            members.extend(near.tolist())
        if len(members) > 1:
            own = fps[members].view(np.int64)
            least = int(own.min())
            found += [(least, x) for x in own.tolist() if x != least]
    return found


def links(marks: DataFrame, groups: int) -> DataFrame:
    """Rows (a, b), a < b, that connect every two of the distinct fingerprints `marks.fp` within MAX_BITS bits."""
    code = embedding(F.col("fp"))
    cells = F.array(*[F.struct(F.lit(i).alias("choice"), code.bitwiseAND(long_literal(m)).alias("cell")) for i, m in enumerate(choices(groups))])
    placed = marks.select("fp", F.explode(cells).alias("at")).select("at.choice", "at.cell", "fp")
    dealt = placed.repartition("choice", "cell").sortWithinPartitions("choice", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        last = None

        def put(found: list[tuple[int, int]]) -> pa.RecordBatch:
            pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            choice, cell, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(fp):
                continue
            fp, found = fp.view(np.uint64), []
            cuts = np.flatnonzero((np.diff(choice) != 0) | (np.diff(cell) != 0)) + 1
            bounds = np.concatenate([[0], cuts, [len(fp)]])
            if (choice[0], cell[0]) != last and held:
                found += cell_links(np.concatenate(held)) if sum(map(len, held)) > 1 else []
                held = []
            if len(bounds) > 2:  # the first run ends within this batch
                held.append(fp[: bounds[1]])
                found += cell_links(np.concatenate(held)) if sum(map(len, held)) > 1 else []
                held = []
                starts, ends = bounds[1:-2], bounds[2:-1]
                many = ends - starts > 1
                for a, b in zip(starts[many].tolist(), ends[many].tolist()):
                    found += cell_links(fp[a:b])
            held.append(fp[bounds[-2] :].copy())
            last = (choice[-1], cell[-1])
            yield put(found)
        if held and sum(map(len, held)) > 1:
            yield put(cell_links(np.concatenate(held)))

    return dealt.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(v, c): every vertex of the edges (a, b) with one common vertex of its component.

    Each round maps a vertex to its least neighbour and carries edges and labels over,
    until no edge is left.
    """
    edges = saved(edges, "edges")
    labels = edges.select(F.col("a").alias("v")).union(edges.select(F.col("b").alias("v"))).distinct().withColumn("c", F.col("v"))
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")), "least")
        labels = saved(labels.join(least, labels.c == least.a, "left").select("v", F.coalesce("to", "c").alias("c")), "labels")
        moved = edges.join(least, "a").select(F.col("to").alias("x"), "b")
        moved = moved.join(least, moved.b == least.a).select("x", F.col("to").alias("y")).where("x <> y")
        edges = saved(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    return labels


def labelled(slim: DataFrame, groups: int | None) -> DataFrame:
    """(fp, first, c) for every fingerprint of `slim` (doc_id, fp): its smallest id, and a fingerprint common to its component."""
    marks = saved(slim.groupBy("fp").agg(F.min("doc_id").alias("first")), "marks")
    labels = components(links(marks, groups or groups_for(marks.count())))
    return marks.join(labels, marks.fp == labels.v, "left").select("fp", "first", F.coalesce("c", "fp").alias("c"))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = SHINGLE, groups: int | None = None) -> DataFrame:
    """(doc_id, fp, component_id) for every document."""
    slim = saved(fingerprints(docs, doc_id=doc_id, text=text, n=n), "fingerprints")
    named = labelled(slim, groups)
    least = named.groupBy("c").agg(F.min("first").alias("component_id"))
    return slim.join(named.join(least, "c").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = SHINGLE) -> DataFrame:
    """One document of each component: that with the smallest id, null last, then the first by a hash of the text; columns as given."""
    name, mark = fresh([doc_id, text], "name", "mark")
    pairs = docs.select(F.struct(col(doc_id).alias("doc_id"), text_mark(col(text)).alias("mark")).alias(name), col(text).alias(mark))
    slim = saved(fingerprints(pairs, doc_id=name, text=mark, n=n).select("doc_id.*", "fp"), "fingerprints")
    found = slim.join(labelled(slim, None).select("fp", "c"), "fp")
    return one_of_each(docs, found.select("doc_id", "mark", "c"), doc_id=doc_id, text=text)
