"""Line dedup by winnowing over line hashes.

A line is what stands between newlines, without white space at its ends. A repeated
run is one or more consecutive lines with `min_words` words or more that occurred
before: in a document with a smaller id, or earlier in the same one without overlap.
The lines of later repeated runs are deleted, the first occurrence stays.

Windows: for every line, the shortest stretch with `min_words` words that begins there,
and the shortest that ends there. Each line of a repeated run lies in such a window
inside the run. A window selects its least line hash, the leftmost of equal ones: equal
windows select the same line, wherever they stand, so no repeat is missed. A line that
many windows select is one fingerprint, put out once with its position and the hashes of
the lines around it that those windows span; equal ones of a text share a row.

Each fingerprint is joined with its first position, and the match is extended both ways
over equal line hashes. What the match holds of the windows is a later repeat of them,
and their union is the run. A window that goes beyond the match may still repeat another,
later position of the fingerprint (a common line in two different passages). Such windows
are grouped by a hash of their lines, and all but the first go too; equal windows are all
within the match or all beyond it, so the two steps lose nothing between them.

A position is joined with one first position only, so no pairs are made of a line that
many documents hold, and the join can be split.

Defined cases: a null text has no lines and stays null; empty lines count as lines of no
words. Order is by id (null first), then by a hash of the text. Rows with equal id and
equal text are one document and keep the same lines. Columns beside the text are kept
as given; the text of an unchanged document is not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from weirstone.llm.common import as_bytes, col, fresh, mapped, saved, slices

MIN_WORDS = 50
# Mark of a line without words, above all others.
NO_WORDS = (1 << 63) - 1


def windows(ends: np.ndarray, first: np.ndarray, last: np.ndarray, min_words: int) -> np.ndarray:
    """Shortest line ranges (a, b) with `min_words` words that begin or end at some line.

    `ends` counts the words of all texts on end; `first` and `last` bound the lines of each line's text.
    """
    before, lines = np.concatenate([[0], ends[:-1]]), np.arange(len(ends))
    b = np.searchsorted(ends, before + min_words)
    a = np.searchsorted(before, ends - min_words, "right") - 1
    forward, backward = b <= last, a >= first
    pairs = np.concatenate([np.stack([lines[forward], b[forward]], 1), np.stack([a[backward], lines[backward]], 1)])
    return np.unique(pairs, axis=0)


def selected(marks: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """For each range the line with the least mark, the leftmost of equal ones: two overlapping powers of two cover it."""
    lengths = spans[:, 1] - spans[:, 0] + 1
    level = np.frexp(lengths)[1] - 1
    out, least = np.zeros(len(spans), dtype=np.int64), np.arange(len(marks))
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            left, right = least[: -(1 << k - 1)], least[1 << k - 1 :]
            least = np.where(marks[right] < marks[left], right, left)
        at = np.flatnonzero(level == k)
        left, right = least[spans[at, 0]], least[spans[at, 1] + 1 - (1 << k)]
        out[at] = np.where(marks[right] < marks[left], right, left)
    return out


def text_fingerprints(texts: list[bytes], min_words: int) -> tuple[list[int], list[tuple[int, list[int], int, bytes, bytes]]]:
    """Fingerprints of some texts, and for each: text, positions, lines before it in its context, line hashes of the context, windows around it."""
    marks, words, start = [], [], [0]
    for text in texts:
        for line in text.split(b"\n"):
            line = line.strip()
            n = len(line.split())
            words.append(n)
            # A line without words is selected by no window.
            marks.append(xxhash.xxh64_intdigest(line) >> 1 if n else NO_WORDS)
        start.append(len(words))
    sizes = np.diff(start)
    first = np.repeat(start[:-1], sizes)
    spans = windows(np.cumsum(words), first, first + np.repeat(sizes, sizes) - 1, min_words)
    if not len(spans):
        return [], []
    hashes = np.array(marks, dtype=np.int64)
    place = selected(hashes, spans)
    order = np.argsort(place, kind="stable")
    place, spans = place[order], spans[order]
    cuts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    points = place[cuts]
    low, high = np.minimum.reduceat(spans[:, 0], cuts), np.maximum.reduceat(spans[:, 1], cuts)
    around = (np.abs(spans - place[:, None])).astype("<i4")
    owner = np.searchsorted(start, points, "right") - 1
    raw, pairs = hashes.astype("<i8").tobytes(), around.tobytes()
    found: dict[tuple, list[int]] = {}
    rows = zip(points.tolist(), owner.tolist(), low.tolist(), high.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(place)])
    for p, text, lo, hi, c, d in rows:
        found.setdefault((text, p - lo, raw[8 * lo : 8 * hi + 8], pairs[8 * c : 8 * d]), []).append(p - start[text])
    fps = [int.from_bytes(context[8 * lead : 8 * lead + 8], "little") for _, lead, context, _ in found]
    return fps, [(text, at, lead, context, near) for (text, lead, context, near), at in found.items()]


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(fp, doc_id, mark, at, lead, context, near): each line that windows select, with its positions in a text; `mark` is a hash of the text."""
    slim = docs.select(col(doc_id).alias("doc_id"), F.xxhash64(col(text)).alias("mark"), col(text).alias("text")).where("text IS NOT NULL")
    schema = StructType([
        StructField("fp", LongType()), StructField("doc_id", slim.schema["doc_id"].dataType), StructField("mark", LongType()), StructField("at", ArrayType(IntegerType())),
        StructField("lead", IntegerType()), StructField("context", BinaryType()), StructField("near", BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                fps, rows = text_fingerprints(as_bytes(part.column(2)), min_words)
                owner, at, lead, context, near = zip(*rows) if rows else ([],) * 5
                own = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fps, pa.int64()), part.column(0).take(own), part.column(1).take(own), pa.array(at, pa.list_(pa.int32())), pa.array(lead, pa.int32()), pa.array(context, pa.binary()), pa.array(near, pa.binary())],
                    names=schema.fieldNames(),
                )

    return slim.mapInArrow(run, schema)


def extent(own: bytes, lead: int, first: bytes, first_lead: int) -> tuple[int, int]:
    """How many equal lines stand before and after two equal ones in their contexts."""
    a, b = np.frombuffer(own, "<i8"), np.frombuffer(first, "<i8")
    left = a[:lead][::-1], b[:first_lead][::-1]
    right = a[lead + 1 :], b[first_lead + 1 :]
    out = []
    for x, y in (left, right):
        n = min(len(x), len(y))
        differ = np.flatnonzero(x[:n] != y[:n])
        out.append(int(differ[0]) if len(differ) else n)
    return out[0], out[1]


def extended(at: list[int], lead: int, context: bytes, near: bytes, first: dict, same: bool) -> Iterator[tuple[int | None, int, int]]:
    """(None, a, b): repeats of the first position's lines; (hash, a, b): windows that go beyond the match."""
    before, after = extent(context, lead, first["context"], first["lead"])
    around = np.frombuffer(near, "<i4").reshape(-1, 2)
    held = (around[:, 0] <= before) & (around[:, 1] <= after)
    inside, beyond = around[held], around[~held].tolist()
    for p in at if len(inside) else ():
        # In the first position's own text a repeat must not overlap it.
        kept = inside[p - inside[:, 0] > first["p"] + inside[:, 1]] if same else inside
        if len(kept):
            yield None, p - int(kept[:, 0].max()), p + int(kept[:, 1].max())
    for left, right in beyond:
        whole = xxhash.xxh3_64_intdigest(context[8 * (lead - left) : 8 * (lead + right) + 8]) >> 1
        for p in at:
            yield whole, p - left, p + right


def repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, mark, ranges): the later repeated line ranges of each document that has any; `mark` is a hash of its text."""
    found = fingerprints(docs, doc_id=doc_id, text=text, min_words=min_words)
    place = F.struct("doc_id", "mark", F.col("at")[0].alias("p"), "lead", "context")
    firsts = found.groupBy("fp").agg(F.sum(F.size("at")).alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    schema = StructType([
        StructField("fp", LongType()), StructField("whole", LongType()), found.schema["doc_id"], StructField("mark", LongType()),
        StructField("a", IntegerType()), StructField("b", IntegerType()),
    ])
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    met = found.join(firsts, "fp").select(
        "fp", "doc_id", "mark", "at", "lead", "context", "near", F.struct("first.p", "first.lead", "first.context").alias("first"), same.alias("same")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 5):
                owner, out = [], []
                for i, row in enumerate(zip(*(part.column(c).to_pylist() for c in range(3, 9)))):
                    for hit in extended(*row):
                        owner.append(i)
                        out.append(hit)
                own = pa.array(owner, pa.int64())
                whole, a, b = zip(*out) if out else ([],) * 3
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(own), pa.array(whole, pa.int64()), part.column(1).take(own), part.column(2).take(own), pa.array(a, pa.int32()), pa.array(b, pa.int32())],
                    names=schema.fieldNames(),
                )

    matches = saved(met.mapInArrow(run, schema), "line-matches")
    beyond = matches.where("whole IS NOT NULL")
    spot = F.struct("doc_id", "mark", "a", "b")
    heads = beyond.groupBy("fp", "whole").agg(F.count("*").alias("n"), F.min(spot).alias("first")).where("n > 1").drop("n")
    before = F.struct(F.col("first.doc_id"), F.col("first.mark")) < F.struct("doc_id", "mark")
    later = beyond.join(heads, ["fp", "whole"]).where((same & (F.col("a") > F.col("first.b"))) | (~same & before))
    gone = matches.where("whole IS NULL").select("doc_id", "mark", "a", "b").unionByName(later.select("doc_id", "mark", "a", "b"))
    return gone.distinct().groupBy("doc_id", "mark").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))


def with_ranges(docs: DataFrame, doc_id: str, text: str, min_words: int, name: str) -> DataFrame:
    """`docs` with a column of the line ranges to delete, null if none."""
    key, mark = fresh([*docs.columns, name], "key", "mark")
    found = repeats(docs, doc_id=doc_id, text=text, min_words=min_words).toDF(key, mark, name)
    return docs.join(found, col(doc_id).eqNullSafe(col(key)) & (F.xxhash64(col(text)) == col(mark)), "left").select(*map(col, docs.columns), col(name))


def deleted(n_lines: int, ranges: list[dict] | None) -> np.ndarray:
    mask = np.zeros(n_lines + 1, dtype=np.int64)
    for r in ranges or ():
        mask[r["a"]] += 1
        mask[r["b"] + 1] -= 1
    return np.cumsum(mask)[:n_lines] > 0


def dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without later repeated runs; one that loses all its words goes."""
    (name,) = fresh(docs.columns, "ranges")
    place, schema = docs.columns.index(text), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, place):
                ranges, keep = part.column(part.num_columns - 1).to_pylist(), [True] * part.num_rows
                columns = list(part.columns[:-1])
                if any(ranges):
                    texts = part.column(place).to_pylist()
                    for i, own in enumerate(ranges):
                        if own:
                            lines = texts[i].split("\n")
                            gone = deleted(len(lines), own)
                            words = np.array([len(x.encode().split()) for x in lines])
                            keep[i] = words[~gone].any()
                            texts[i] = "\n".join(x for x, g in zip(lines, gone) if not g)
                    columns[place] = pa.array(texts, columns[place].type)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-1]).filter(pa.array(keep))

    return mapped(with_ranges(docs, doc_id, text, min_words, name), run, schema)


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per document: lines and words, how many of them are later repeats, the repeated runs, and the text that stays."""
    slim = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    schema = StructType([
        slim.schema["doc_id"], StructField("n_lines", LongType()), StructField("n_words", LongType()), StructField("removed_lines", LongType()),
        StructField("removed_words", LongType()), StructField("runs", StringType()), StructField("kept", StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                out: list[list] = [[] for _ in range(6)]
                for text, own in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    lines = [] if text is None else text.split("\n")
                    gone = deleted(len(lines), own)
                    words = np.array([len(x.encode().split()) for x in lines], dtype=np.int64)
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                    runs = ",".join(f"{a}:{b}" for a, b in zip(edges[::2], edges[1::2]))
                    kept = text if not own else "\n".join(x for x, g in zip(lines, gone) if not g)
                    for column, value in zip(out, (len(lines), int(words.sum()), int(gone.sum()), int(words[gone].sum()), runs, kept)):
                        column.append(value)
                types = [pa.int64()] * 4 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(out, types))], names=schema.fieldNames())

    return with_ranges(slim, "doc_id", "text", min_words, "ranges").mapInArrow(run, schema)
