"""Chat formatting by columnar byte assembly.

A conversation becomes, turn after turn,

    <|im_start|>role\\n text <|im_end|>\\n

(without the blanks). Inside roles and texts a backslash is doubled and a backslash is put
behind the first character of every control string, so none of them occurs; in roles a
newline becomes backslash n. `unescape` is the exact reverse.

Per batch of turns the lengths of headers, texts and ends give offsets, the offsets give
scatter indices, and all bytes are copied into one preallocated buffer that backs the
Arrow array. Turns are dealt by ranges of (conversation, turn), so a long conversation
spreads over tasks; it comes out in pieces that `part` and `piece` put in order. The loss
mask lists the character ranges of the assistant's texts in each piece.

Defined cases: a null text or role is empty. Rows of one conversation with the same turn go
by role, then text, null first; repeated rows are all kept. A null turn comes first. The
rows without conv_id are one conversation with a null id. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from weirstone.llm.common import col, slices

BEGIN, BREAK, END = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNT = "assistant"
# No text may hold one of these, whatever model reads it.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))
TURN = re.compile(re.escape(BEGIN) + r"(.*?)\n(.*?)" + re.escape(END), re.S)
ESCAPE = re.compile(r"\\(.)", re.S)


def escaped(texts: pa.Array) -> pa.Array:
    found = pc.replace_substring(texts, "\\", "\\\\")
    for control in CONTROLS:
        found = pc.replace_substring(found, control, control[0] + "\\" + control[1:])
    return found


def unescape(text: str) -> str:
    return ESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], text) if "\\" in text else text


def strings(column: pa.Array) -> pa.Array:
    """A string column with 64-bit offsets that start at 0, null as empty."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array."""
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), places


def scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, places: np.ndarray) -> None:
    """Copy segment i of `data` to out[at[i]:]."""
    lengths = np.diff(places)
    shift = np.repeat(at - places[:-1], lengths)
    source = np.arange(places[0], places[-1])
    out[source + shift] = data[places[0] : places[-1]]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, pa.Buffer, np.ndarray, pa.Array]:
    """Turn offsets and bytes of the formatted turns, length of each header, and the escaped texts."""
    named = pc.replace_substring(escaped(strings(roles)), "\n", "\\n")
    heads = pc.binary_join_element_wise(pa.scalar(BEGIN, pa.large_string()), named, pa.scalar(BREAK, pa.large_string()), pa.scalar("", pa.large_string()))
    bodies = escaped(strings(texts))
    (head, head_at), (body, body_at) = bytes_of(heads), bytes_of(bodies)
    end = np.frombuffer(END.encode(), np.uint8)
    lengths = np.stack([np.diff(head_at), np.diff(body_at), np.full(len(bodies), len(end))], axis=1)
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    starts = ends - lengths
    buffer = pa.allocate_buffer(int(ends[-1, -1]))
    out = np.frombuffer(buffer, np.uint8)
    scatter(out, starts[:, 0], head, head_at)
    scatter(out, starts[:, 1], body, body_at)
    out[starts[:, 2][:, None] + np.arange(len(end))] = end
    return np.concatenate([starts[:, 0], ends[-1:, 2]]), buffer, pc.utf8_length(heads).to_numpy(), bodies


def format_chat(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, part, piece, n_turns, formatted, loss): the pieces of every conversation, to be read by part and piece."""
    rows = turns.select(col(conv_id).alias("conv_id"), col(turn).alias("turn"), col(role).cast("string").alias("role"), col(text).alias("text"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    dealt = rows.repartitionByRange(*order[:2]).withColumn("part", F.spark_partition_id()).sortWithinPartitions(*order)
    schema = StructType([
        rows.schema["conv_id"], StructField("part", IntegerType()), StructField("piece", IntegerType()), StructField("n_turns", LongType()),
        StructField("formatted", StringType()), StructField("loss", SPANS),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, shape = 0, to_arrow_schema(schema)
        for batch in batches:
            for few in slices(batch, 3):
                ids = few.column(0)
                same = pc.fill_null(pc.equal(ids[1:], ids[:-1]), False).to_numpy(zero_copy_only=False) | (
                    pc.is_null(ids[1:]).to_numpy(zero_copy_only=False) & pc.is_null(ids[:-1]).to_numpy(zero_copy_only=False)
                )
                firsts = np.concatenate([[0], np.flatnonzero(~same) + 1])
                places, buffer, head_chars, bodies = assemble(few.column(2), few.column(3))
                after = np.append(firsts[1:], few.num_rows)
                formatted = pa.LargeStringArray.from_buffers(len(firsts), pa.py_buffer(np.append(places[firsts], places[-1]).tobytes()), buffer)
                chars = pc.utf8_length(bodies).to_numpy()
                ends = np.cumsum(head_chars + chars + len(END))
                start = ends - chars - len(END)
                base = np.repeat((ends - head_chars - chars - len(END))[firsts], after - firsts)
                learnt = np.flatnonzero(pc.fill_null(pc.equal(few.column(2), LEARNT), False).to_numpy(zero_copy_only=False))
                spans = [[] for _ in firsts]
                for i, owner in zip(learnt.tolist(), (np.searchsorted(firsts, learnt, "right") - 1).tolist()):
                    spans[owner].append({"start": int(start[i] - base[i]), "end": int(start[i] + chars[i] - base[i])})
                numbers = np.arange(piece, piece + len(firsts), dtype=np.int32)
                piece += len(firsts)
                columns = [ids.take(pa.array(firsts)), few.column(4).take(pa.array(firsts)), numbers, after - firsts, formatted, spans]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, shape)], schema=shape)

    return dealt.mapInArrow(run, schema)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted piece; raises ValueError on anything else."""
    found, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text between turns")
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("text between turns")
    return found


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its pieces: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).

    A digest runs over a conversation in order, so its pieces pass through one task, as a
    sorted stream of which nothing is kept but the running digests.
    """
    dealt = formatted.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "piece")
    schema = StructType([
        formatted.schema["conv_id"], StructField("n_turns", LongType()), StructField("turns_sha256", StringType()), StructField("loss_chars", LongType()),
        StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = to_arrow_schema(schema)
        known = open_ = None

        def closed() -> tuple:
            n, turns, chars, loss, total = open_
            return known, n, turns.hexdigest(), chars, loss.hexdigest(), total

        for batch in batches:
            done = []
            for few in slices(batch, 4):
                for conv, text, spans in zip(*(few.column(i).to_pylist() for i in (0, 4, 5))):
                    if open_ is None or conv != known:
                        if open_ is not None:
                            done.append(closed())
                        known, open_ = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    for role, said in parse(text):
                        open_[0] += 1
                        open_[1].update(f"{role}\n{said}\n".encode())
                    for s in spans:
                        said = unescape(text[s["start"] : s["end"]])
                        open_[2] += len(said)
                        open_[3].update(said.encode())
                    open_[4] += len(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), shape)], schema=shape)
        if open_ is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(closed(), shape)], schema=shape)

    return dealt.mapInArrow(run, schema)
