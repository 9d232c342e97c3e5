"""Benchmark decontamination by a broadcast hash set of test n-grams.

Words are runs of digits, letters a-z (A-Z lower-cased first) and non-ASCII
characters. A window is `n` consecutive words of a benchmark item; an item with
fewer words, but not none, is one window. Windows become 64-bit hashes of word
numbers; the words of a document are hashed window by window in numpy, looked up,
and every hit is verified word by word.

The set is broadcast in blocks of at most `block` (window, item) rows, so its size
is bounded whatever the benchmark's; each block scans the documents once.

Defined cases: a null or empty text has no words and is clean. A null or empty item
has no windows. An item with a null id marks words, but is not listed. Repeated
items and windows count once. An empty benchmark leaves every document as it is.
Repeated documents are judged one by one. Columns beside id and text are kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from weirstone.llm.common import as_bytes, col, fresh, mapped, saved, slices

WINDOW = 10
# (window, item) rows per broadcast block: under 64 MB in a worker.
BLOCK = 200_000

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WORD_SQL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIX = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 20

HITS = ArrayType(StructType([StructField("at", IntegerType()), StructField("len", IntegerType()), StructField("item", StringType())]))


def item_windows(bench: DataFrame, *, item_id: str = "item_id", text: str = "text", n: int = WINDOW) -> DataFrame:
    """Distinct (window, item): words joined by one space, the item's id as a string."""
    words = F.regexp_extract_all(F.translate(col(text), UPPER, LOWER), F.lit(WORD_SQL), F.lit(0))
    listed = bench.select(col(item_id).cast("string").alias("item"), words.alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - n + 1, F.lit(1)))
    windows = F.transform(starts, lambda i: F.array_join(F.slice("words", i, n), " "))
    return listed.select("item", F.explode(windows).alias("window")).distinct()


class Blocks(Sequence):
    """The (window, item) rows in parts of about `size`, read when asked for; at least one part."""

    def __init__(self, windows: DataFrame, size: int):
        self.windows = windows
        self.parts = max(1, -(-windows.count() // size))

    def __len__(self) -> int:
        return self.parts

    def __getitem__(self, part: int) -> list[tuple[str, str | None]]:
        if not 0 <= part < self.parts:
            raise IndexError(part)
        share = self.windows
        if self.parts > 1:
            share = share.where(F.pmod(F.xxhash64("window", "item"), F.lit(self.parts)) == part)
        return [(r["window"], r["item"]) for r in share.collect()]


class Vocabulary(dict):
    """Numbers words from 1; a word of no window is 0."""

    def __missing__(self, word: bytes) -> int:
        return 0


class Matcher:
    """Looks the windows of many documents up at once."""

    def __init__(self, rows: list[tuple[str, str | None]]):
        self.vocabulary = Vocabulary()
        by_length: dict[int, dict[tuple[int, ...], set]] = {}
        for window, item in rows:
            words = window.encode().split(b" ")
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
            numbers = tuple(self.vocabulary[w] for w in words)
            by_length.setdefault(len(words), {}).setdefault(numbers, set()).add(item)
        self.tables = []
        for length, windows in sorted(by_length.items()):
            words = np.array(list(windows), dtype=np.uint64)
            hashes = self.hashed([words[:, k] for k in range(length)])
            order = np.argsort(hashes, kind="stable")
            maybe = np.zeros(1 << FILTER_BITS, dtype=bool)
            maybe[hashes >> np.uint64(64 - FILTER_BITS)] = True
            items = list(windows.values())
            self.tables.append((length, words[order], hashes[order], maybe, [items[i] for i in order]))

    @staticmethod
    def hashed(columns: list[np.ndarray]) -> np.ndarray:
        h = np.zeros(len(columns[0]), dtype=np.uint64)
        for c in columns:
            h = (h + c) * MIX
            h ^= h >> np.uint64(29)
        return h * MIX

    def matches(self, numbers: np.ndarray) -> Iterator[tuple[int, int, set]]:
        """(position, length, items) of every window found in a run of word numbers."""
        for length, words, hashes, maybe, items in self.tables:
            if len(numbers) < length:
                continue
            n = len(numbers) - length + 1
            h = self.hashed([numbers[k : k + n] for k in range(length)])
            at = np.flatnonzero(maybe[h >> np.uint64(64 - FILTER_BITS)])
            if not len(at):
                continue
            sought = h[at]
            lo, hi = np.searchsorted(hashes, sought, "left"), np.searchsorted(hashes, sought, "right")
            for i, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                for k in range(a, b):
                    if np.array_equal(words[k], numbers[i : i + length]):
                        yield i, length, items[k]

    def found(self, texts: list[bytes]) -> tuple[list[int], dict[int, list[tuple[int, int, set]]]]:
        """Word counts, and the matches of the documents that have any."""
        split = [WORD.findall(t.lower()) for t in texts]
        counts = [len(w) for w in split]
        # A 0 after each document: no window holds it, so none crosses documents.
        numbers = np.zeros(sum(counts) + len(counts), dtype=np.uint64)
        starts, place = [], 0
        number = self.vocabulary.__getitem__
        for words in split:
            numbers[place : place + len(words)] = list(map(number, words))
            starts.append(place)
            place += len(words) + 1
        hits: dict[int, list] = {}
        for i, length, items in self.matches(numbers):
            doc = int(np.searchsorted(starts, i, "right")) - 1
            hits.setdefault(doc, []).append((i - starts[doc], length, items))
        return counts, hits


def covered(n_words: int, hits: list[tuple[int, int]]) -> np.ndarray:
    """Which words lie inside a hit."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    for at, length in hits:
        edge[at] += 1
        edge[at + length] -= 1
    return np.cumsum(edge)[:n_words] > 0


Finish = Callable[[pa.RecordBatch, list[int], list[list[dict] | None], "Matcher"], pa.RecordBatch]


def scanned(docs: DataFrame, parts: Sequence[list], text: str, finish: Finish, result: StructType) -> DataFrame:
    """`docs` searched for each part of the windows in turn; after the last, `finish` makes the rows.

    `finish` gets some rows, their word counts, and per row the found
    {at: word position, len: words, item} or None.
    """
    spark = docs.sparkSession
    (hits,) = fresh(docs.columns, "hits")
    place = docs.columns.index(text)
    state = pa.list_(pa.struct([("at", pa.int32()), ("len", pa.int32()), ("item", pa.string())]))
    df = docs.withColumn(hits, F.lit(None).cast(HITS))
    for number, rows in enumerate(parts, 1):
        sent, last = spark.sparkContext.broadcast(rows), number == len(parts)

        def scan(batches: Iterator[pa.RecordBatch], sent=sent, last=last) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value)
            for batch in batches:
                for part in slices(batch, place):
                    counts, found = matcher.found(as_bytes(part.column(place)))
                    known = part.column(part.num_columns - 1).to_pylist()
                    for i, matches in found.items():
                        known[i] = (known[i] or []) + [{"at": a, "len": k, "item": x} for a, k, items in matches for x in items]
                    if last:
                        own = pa.RecordBatch.from_arrays(part.columns[:-1], names=part.schema.names[:-1])
                        yield finish(own, counts, known, matcher)
                    else:
                        yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(known, state)], names=part.schema.names)

        df = mapped(df, scan, result if last else df.schema)
        df = df if last else saved(df, "leaks")
    return df


def find(
    docs: DataFrame, bench: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    n: int = WINDOW, block: int = BLOCK,
) -> DataFrame:
    """One row per document: (doc_id, n_words, n_hit, n_items, items, contaminated)."""
    slim = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    result = StructType([
        StructField("doc_id", slim.schema["doc_id"].dataType), StructField("n_words", LongType()), StructField("n_hit", LongType()),
        StructField("n_items", LongType()), StructField("items", ArrayType(StringType())), StructField("contaminated", BooleanType()),
    ])

    def judge(part: pa.RecordBatch, counts: list[int], found: list[list[dict] | None], matcher: Matcher) -> pa.RecordBatch:
        schema = to_arrow_schema(result)
        n_hit = [int(covered(k, [(h["at"], h["len"]) for h in hits]).sum()) if hits else 0 for k, hits in zip(counts, found)]
        items = [sorted({h["item"] for h in hits if h["item"] is not None}) if hits else [] for hits in found]
        columns = [counts, n_hit, [len(x) for x in items], items, [k > 0 for k in n_hit]]
        return pa.RecordBatch.from_arrays(
            [part.column(0).cast(schema.field(0).type), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))], schema=schema
        )

    return scanned(slim, Blocks(item_windows(bench, item_id=item_id, text=item_text, n=n), block), "text", judge, result)


def clean_text(text: bytes, hits: list[tuple[int, int]]) -> bytes:
    """The text without the stretches from the first to the last word of each run of hit words."""
    spans = [m.span() for m in WORD.finditer(text.lower())]
    mask = np.concatenate([[False], covered(len(spans), hits), [False]])
    edges = np.flatnonzero(mask[1:] != mask[:-1])
    kept, last = [], 0
    for first, after in zip(edges[::2].tolist(), edges[1::2].tolist()):
        kept.append(text[last : spans[first][0]])
        last = spans[after - 1][1]
    return b"".join([*kept, text[last:]])


def decontaminate(
    docs: DataFrame, bench: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    n: int = WINDOW, block: int = BLOCK, drop_share: float = 0.5,
) -> DataFrame:
    """The documents without benchmark passages, columns as given.

    Hit words are cut out; a document with more than `drop_share` of its words hit
    is removed. Cutting can bring words together that form a window again, so cut
    texts are searched until they are clean: in the same task for a benchmark of one
    block, else by another pass over the documents.
    """
    place, schema = docs.columns.index(text), docs.schema
    parts = Blocks(item_windows(bench, item_id=item_id, text=item_text, n=n), block)
    single = len(parts) == 1

    def cut(part: pa.RecordBatch, counts: list[int], found: list[list[dict] | None], matcher: Matcher) -> pa.RecordBatch:
        if not any(found):
            return part
        texts, keep = part.column(place).to_pylist(), [True] * part.num_rows
        for i, hits in enumerate(found):
            spans = [(h["at"], h["len"]) for h in hits or ()]
            if spans and covered(counts[i], spans).sum() > drop_share * counts[i]:
                keep[i] = False
            elif spans:
                raw = texts[i].encode()
                while spans:
                    raw = clean_text(raw, spans)
                    spans = [(a, k) for a, k, _ in matcher.found([raw])[1].get(0, [])] if single else []
                texts[i] = raw.decode()
        columns = list(part.columns)
        columns[place] = pa.array(texts, columns[place].type)
        return pa.RecordBatch.from_arrays(columns, names=part.schema.names).filter(pa.array(keep))

    df = scanned(docs, parts, text, cut, schema)
    while not single:
        df = saved(df, "cut")
        if find(df, bench, doc_id=docs.columns[0], text=text, item_id=item_id, item_text=item_text, n=n, block=block).where("n_hit > 0").isEmpty():
            break
        df = scanned(df, parts, text, cut, schema)
    return df
