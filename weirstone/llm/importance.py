"""Importance resampling towards a target distribution over hashed word n-grams.

Texts are lower-cased (A-Z), every run of characters that are no word characters becomes one
space, and one overlapped regex scan with boundary look-arounds matches up to `n` words from
every word on; the groups of a match are the spans of its n-grams. A span's CRC-32 goes on
from that of the shorter span before it, and modulo `buckets` it names the feature's bucket.

With S features of the documents, s in a bucket, and T and t of the target texts, a bucket
gains floor(1000 * ln((t + 1) * (S + B) / ((s + 1) * (T + B)))), B the number of buckets. A
document's weight is the sum of its features' gains. Adding Gumbel noise from a hash of the
seed and the id and taking the highest scores draws without replacement in proportion to the
weights' exponentials.

Buckets of all features are written once, two to four bytes each, so texts are scanned once.
Counts are added up per task and come to the driver as `buckets` numbers. The drawn rows are
ranked in ranges of the score: only ids and numbers are moved, and no task holds more than its
range.

Defined cases: a null or empty text has no features and weight 0; target rows that are null or
empty count nothing. A null id hashes as an empty string and comes last among ties; rows with
equal score and id are ordered by their number of features, and repeated rows all take part.
An empty table gives an empty table; without target features gains follow the formula with
T = 0. Columns beside those used are kept by `weighed` and `drawn`.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from weirstone.llm.common import as_bytes, col, fresh, mapped, saved, slices

N, BUCKETS, SEED = 3, 10_000, 42
LEAST_WORDS, PERCENT = 20, 5
SCALE = 1000
SEPARATE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
# Features turned into numbers at a time.
CHUNK = 1 << 16


def scanner(n: int) -> regex.Pattern:
    """Matches of 1 to `n` words from a word's begin on, a group per word."""
    more = b""
    for _ in range(n - 1):
        more = b"(?: ([^ ]++)" + more + b")?+"
    return regex.compile(b"(?<![^ ])([^ ]++)" + more + b"(?![^ ])")


def features(text: bytes, pattern: regex.Pattern, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every n-gram."""
    plain = b" ".join(text.translate(SEPARATE).split())
    crc32, found, done, words = zlib.crc32, array("I"), [], 0
    add = found.append
    for match in pattern.finditer(plain, overlapped=True):
        words += 1
        spans = match.regs
        start, end = spans[1]
        code = crc32(plain[start:end])
        add(code)
        for _, more in spans[2:]:
            if more < 0:
                break
            code = crc32(plain[end:more], code)
            end = more
            add(code)
        if len(found) > CHUNK:
            done.append(np.frombuffer(found, np.uint32) % buckets)
            found = array("I")
            add = found.append
    done.append(np.frombuffer(found, np.uint32) % buckets)
    return words, np.concatenate(done)


def width(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def bucketed(rows: DataFrame, n: int, buckets: int, names: list[str]) -> DataFrame:
    """`rows` with columns for the words, the features and the features' buckets as bytes in place of the last column, a text."""
    place = len(rows.columns) - 1
    schema = StructType([*rows.schema.fields[:-1], StructField(names[0], LongType()), StructField(names[1], LongType()), StructField(names[2], BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, kind = scanner(n), width(buckets)
        for batch in batches:
            for part in slices(batch, place):
                found = [features(t, pattern, buckets) for t in as_bytes(part.column(place))]
                columns = [pa.array([f[0] for f in found], pa.int64()), pa.array([len(f[1]) for f in found], pa.int64())]
                held = pa.array([f[1].astype(kind).tobytes() for f in found], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns, held], names=schema.fieldNames())

    return mapped(rows, run, schema)


def counts(held: DataFrame, name: str, buckets: int) -> np.ndarray:
    """Features per bucket over all rows of a column of buckets."""
    kind = width(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                own += np.bincount(np.frombuffer(b"".join(as_bytes(part.column(0))), kind), minlength=buckets)
        used = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(own[used])], names=["bucket", "n"])

    sums = held.select(col(name)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, np.int64)
    for r in sums.collect():
        total[r["bucket"]] = r["n"]
    return total


def gains(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Gain of every bucket from its counts in the documents and in the target."""
    b, all_s, all_t = len(s), int(s.sum()), int(t.sum())
    return np.array([
        math.floor(SCALE * math.log(float(ti + 1) * float(all_s + b) / (float(si + 1) * float(all_t + b)))) for si, ti in zip(s.tolist(), t.tolist())
    ], np.int64)


def noise(doc_id, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def ranked(rows: DataFrame, order: list[Column], count: int, out: str) -> DataFrame:
    """`rows` with the place by `order` from 1 in the column `out`, null beyond `count`.

    Ranges of the order are ranked each on its own and begin where the ones before end.
    """
    (part,) = fresh([*rows.columns, out], "part")
    dealt = saved(rows.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy(part).agg(F.count("*").alias(out))
    before = sizes.withColumn(out, F.sum(out).over(Window.orderBy(part)) - col(out))
    place = F.row_number().over(Window.partitionBy(col(part)).orderBy(*order)) + col(out)
    # A range of which nothing is drawn needs no order.
    dealt = dealt.join(F.broadcast(before), part)
    drawn = dealt.where(col(out) < count).withColumn(out, place.cast("long"))
    drawn = drawn.withColumn(out, F.when(col(out) <= count, col(out)))
    return drawn.unionByName(dealt.where(col(out) >= count).withColumn(out, F.lit(None).cast("long"))).drop(part)


def weighed(
    docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", n: int = N, buckets: int = BUCKETS,
    seed: int = SEED, least_words: int = LEAST_WORDS, percent: float = PERCENT, keep: list[str] | None = None,
    names: tuple[str, ...] = ("n_features", "weight", "score", "rank"),
) -> DataFrame:
    """The columns `keep` of the documents (all, if not given) and `names`: features, weight, score, and the rank of a drawn document.

    Drawn are `percent` % of the documents with `least_words` words or more, by score, ties to the smaller id.
    """
    kept = docs.columns if keep is None else keep
    number, body, words, held = fresh([*kept, *names], "number", "body", "words", "held")
    n_features, weight, score, rank = names
    shown = docs.select(*map(col, kept), col(doc_id).alias(number), col(text).alias(body))
    found = saved(bucketed(shown, n, buckets, [words, n_features, held]), "features")
    aim = bucketed(target.select(col(target_text).alias("text")), n, buckets, ["words", "n", "held"])
    sent = docs.sparkSession.sparkContext.broadcast(gains(counts(found, held, buckets), counts(aim, "held", buckets)))
    kind, id_place = width(buckets), len(kept)
    fields = [f for f in found.schema.fields if f.name != held]
    schema = StructType([*fields, StructField(weight, LongType()), StructField(score, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                weights = [int(gain[np.frombuffer(b, kind)].sum()) for b in as_bytes(part.column(part.num_columns - 1))]
                scores = [w + noise(i, seed) for w, i in zip(weights, part.column(id_place).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(weights, pa.int64()), pa.array(scores, pa.int64())], names=schema.fieldNames())

    rows = saved(mapped(found, run, schema), "weights")
    enough = rows.where(col(words) >= least_words)
    order = [col(score).desc(), col(number).asc_nulls_last(), col(n_features).asc()]
    drawn = ranked(enough, order, math.floor(percent * enough.count() / 100), rank)
    others = rows.where(col(words) < least_words).withColumn(rank, F.lit(None).cast("long"))
    return drawn.unionByName(others).select(*map(col, [*kept, *names]))


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, columns as given."""
    names = fresh(docs.columns, "n_features", "weight", "score", "rank")
    return weighed(docs, target, names=tuple(names), **options).where(col(names[3]).isNotNull()).select(*map(col, docs.columns))
