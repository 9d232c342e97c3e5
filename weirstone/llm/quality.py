"""Quality classifier: a factorisation machine over a text's words, structure and length.

    score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

The pair sum is 0.5 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), so a text costs
time linear in its features.

Features: hashed words (lower-cased, weights of unit length over the text), and one
marker per structure statistic and for the length column, each cut into fixed bins.
Language, source, ids and labels are no features.

The model is fitted on a bounded sample of labelled rows (`sample_rows`, the smallest
hashes of the id), which the driver gets as features, with seeded steps: reruns agree.
It has a fixed size and is broadcast.

Defined cases: an empty or null text has structure markers only and gets a score; a null
length counts as the text's own. Repeated or conflicting labels of an id count as their
mean, 0.5 or more as 1; labels other than 0 and 1 and labels without document are
ignored. Without any label to learn from every score is 0.5. A null id is not held out
and has no label. Repeated documents are scored one by one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from weirstone.llm.common import as_bytes, col, fresh, mapped, slices

SAMPLE_ROWS = 4000
BUCKETS = 1 << 14
RANK = 8
EPOCHS, BATCH, RATE, DECAY = 12, 128, 0.1, 1e-5
# Words whose buckets a worker remembers.
CACHE = 300_000

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
JUNK = b"#$%&*+/<=>@[\\]^_`{|}~"
# Bins of a share; of a count, by its logarithm.
SHARES = np.array([0.0005, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7])
SIZES = np.array([1, 4, 16, 50, 120, 300, 800, 2000, 6000, 20000, 100000])
LENGTHS = np.array([2, 3, 3.5, 4, 4.5, 5, 5.5, 6, 7, 9, 14])
SLOTS = 12
STATISTICS = 13
FEATURES = BUCKETS + STATISTICS * SLOTS


def structure(text: bytes, words: list[bytes], distinct: int, n_chars: int) -> list[int]:
    """Marker numbers of a text's structure statistics and length."""
    n, lines = max(len(text), 1), text.split(b"\n")
    n_words = max(len(words), 1)

    def share(symbols: bytes) -> float:
        return (len(text) - len(text.translate(None, symbols))) / n

    values = [
        (SHARES, share(UPPER)), (SHARES, share(DIGITS)), (SHARES, share(JUNK)), (SHARES, share(b"!?")), (SHARES, share(b".,;:")),
        (SHARES, share(b" \t\r")), (SHARES, share(bytes(range(128, 256)))), (SIZES, len(words)), (LENGTHS, sum(map(len, words)) / n_words),
        (SHARES, 1 - distinct / n_words), (SHARES, 1 - len(set(lines)) / len(lines)), (SIZES, len(words) / len(lines)), (SIZES, n_chars),
    ]
    return [BUCKETS + k * SLOTS + int(np.searchsorted(bins, value, "right")) for k, (bins, value) in enumerate(values)]


def features(text: bytes, n_chars: int, known: dict[bytes, int]) -> tuple[list[int], list[float]]:
    """Feature numbers and weights of one text; `known` remembers word buckets."""
    words = text.lower().split()
    counts = Counter(words)
    if len(known) > CACHE:
        known.clear()
    numbers = []
    for word in counts:
        bucket = known.get(word)
        if bucket is None:
            bucket = known[word] = zlib.crc32(word) % BUCKETS
        numbers.append(bucket)
    weights = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    weights /= max(np.sqrt((weights * weights).sum()), 1e-12)
    marks = structure(text, words, len(counts), n_chars)
    return numbers + marks, weights.tolist() + [1.0] * len(marks)


def encoded(texts: list[bytes], n_chars: list[int], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of many texts one after the other, and where each begins; a text has at least its markers."""
    numbers, weights, starts = [], [], []
    for text, n in zip(texts, n_chars):
        own, w = features(text, n, known)
        starts.append(len(numbers))
        numbers += own
        weights += w
    return np.array(numbers, np.int64), np.array(weights), np.array(starts, np.int64)


@dataclass
class Model:
    bias: float
    w: np.ndarray
    v: np.ndarray

    def parts(self, numbers: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Raw score per text, with the factor products and sums that its gradient needs."""
        z = self.v[numbers] * x[:, None]
        s = np.add.reduceat(z, starts)
        pairs = 0.5 * (s * s - np.add.reduceat(z * z, starts)).sum(axis=1)
        return self.bias + np.add.reduceat(self.w[numbers] * x, starts) + pairs, z, s

    def scores(self, numbers: np.ndarray, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.parts(numbers, x, starts)[0], -30, 30)))


def fit(rows: list[tuple[list[int], list[float], int]], seed: int = 7) -> Model:
    """Logistic loss, adaptive steps over mini-batches in a seeded order."""
    rng = np.random.default_rng(seed)
    model = Model(0.0, np.zeros(FEATURES), rng.normal(0, 0.01, (FEATURES, RANK)))
    if not rows:
        model.v[:] = 0
        return model
    sums = [1e-8, np.full(FEATURES, 1e-8), np.full((FEATURES, RANK), 1e-8)]
    labels = np.array([r[2] for r in rows], dtype=np.float64)
    packed = [(np.array(r[0], np.int64), np.array(r[1])) for r in rows]
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            chosen = order[at : at + BATCH]
            numbers, x = (np.concatenate([packed[i][k] for i in chosen]) for k in range(2))
            lengths = [len(packed[i][0]) for i in chosen]
            starts = np.cumsum([0, *lengths[:-1]])
            raw, z, s = model.parts(numbers, x, starts)
            off = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]) / len(chosen)
            each = np.repeat(off, lengths) * x
            slope = (np.repeat(s, lengths, axis=0) - z) * each[:, None]
            used, place = np.unique(numbers, return_inverse=True)
            gw = np.bincount(place, each, len(used)) + DECAY * model.w[used]
            gv = np.stack([np.bincount(place, slope[:, f], len(used)) for f in range(RANK)], axis=1) + DECAY * model.v[used]
            sums[0] += off.sum() ** 2
            sums[1][used] += gw * gw
            sums[2][used] += gv * gv
            model.bias -= RATE * off.sum() / np.sqrt(sums[0])
            model.w[used] -= RATE * gw / np.sqrt(sums[1][used])
            model.v[used] -= RATE * gv / np.sqrt(sums[2][used])
    return model


def held_out(doc_id) -> "F.Column":
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def text_and_length(docs: DataFrame, text: str, n_chars: str | None) -> list:
    length = F.length(col(text)).cast("long") if n_chars is None else F.coalesce(col(n_chars).cast("long"), F.length(col(text)).cast("long"))
    return [col(text).alias("text"), F.coalesce(length, F.lit(0)).alias("n_chars")]


def train(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """A model learnt from at most `sample_rows` labelled documents that are not held out."""
    order = [F.xxhash64("id"), F.col("id")]
    marked = (
        labels.where(col(label).isin(0, 1)).select(col("doc_id").alias("id"), col(label).alias("y")).where(F.col("id").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    )
    ids = docs.select(col(doc_id).alias("id"))
    # Bounded by the limit, so both sides of what follows are small or filtered by a broadcast.
    sample = marked.join(ids, "id", "left_semi").orderBy(*order).limit(sample_rows)
    rows = docs.select(col(doc_id).alias("id"), *text_and_length(docs, text, n_chars)).join(F.broadcast(sample), "id")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch, 1):
                found = [features(t, n, known) for t, n in zip(as_bytes(part.column(1)), part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(3), pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float32()))],
                    names=["id", "y", "numbers", "weights"],
                )

    schema = StructType([
        rows.schema["id"], rows.schema["y"], StructField("numbers", ArrayType(IntegerType())), StructField("weights", ArrayType(FloatType())),
    ])
    # The same bound again: an id may stand on many rows.
    taken = rows.mapInArrow(encode, schema).orderBy(*order, F.xxhash64("numbers", "weights")).limit(sample_rows).toArrow()
    return fit([(r["numbers"], r["weights"], r["y"]) for r in taken.to_pylist()])


def score(docs: DataFrame, model: Model, *, text: str = "text", n_chars: str | None = "n_chars", out: str = "score") -> DataFrame:
    """`docs` with the column `out`, between 0 and 1."""
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, model.w.astype(np.float32), model.v.astype(np.float32)))
    body, length = fresh([*docs.columns, out], "body", "length")
    shown = [x.alias(n) for x, n in zip(text_and_length(docs, text, n_chars), (body, length))]
    schema = StructType([*docs.schema.fields, StructField(out, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = Model(*sent.value), {}
        for batch in batches:
            place = batch.num_columns - 2
            for part in slices(batch, place):
                found = own.scores(*encoded(as_bytes(part.column(place)), part.column(place + 1).to_pylist(), known))
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(found, pa.float64())], names=schema.fieldNames())

    return mapped(docs.select("*", *shown), run, schema)
