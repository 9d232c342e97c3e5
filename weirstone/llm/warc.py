"""WARC archives: one gzip member per record, written and read by Spark tasks.

`write` puts each page into a record. Of pages with equal payloads of at least `min_bytes`
bytes, the one with the largest page_id becomes a response, the others revisit it without
a payload; shorter payloads are all responses. Each task writes archives of its own under
names that no other attempt uses; only those that the finished tasks list in the manifest
count, so retried and speculative tasks do no harm.

`read` goes through the archives in sequence: it inflates a member piece by piece, frames
the record by its content length and verifies payload and block digests as it goes; a
record costs a fixed amount of memory unless its payload is asked for. A truncated,
misframed or altered record raises ValueError.

Digests are compared by Spark's SHA-1 of the payload, counted before the shuffle; the
archive rows are joined with the repeated digests only, on the side that can be split.

Defined cases: a null html is an empty payload; a null url an empty target; a null
page_id revisits the largest id of its payload, and is a response if its payload has no
other id. Rows equal in page_id and payload are one response each. URLs are stored with
white space, control and non-ASCII characters percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from weirstone.llm.common import col, saved

FILE_BYTES = 256 << 20
PIECE = 1 << 16
LEVEL = 4
DATE = "2000-01-01T00:00:00Z"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = StructType([StructField("path", StringType()), StructField("records", LongType()), StructField("bytes", LongType())])


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page: str | None, digest: str) -> str:
    """The same for the same page and payload, wherever it is written."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def head_of(fields: list[tuple[str, str]]) -> bytes:
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode()


def record(page: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record as a gzip member; with `refers_to` a revisit, which leaves the payload out."""
    digest = base32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page, digest)), ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"),
    ]
    if page is not None:
        fields.append(("X-Page-ID", page))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", refers_to)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return member(head_of(fields) + block + END)


def info() -> bytes:
    body = b"format: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(body)))]
    return member(head_of(fields) + body + END)


def member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def write(
    pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write archives below `folder`, which all executors share; returns their manifest (path, records, bytes)."""
    body = F.coalesce(col(html), F.lit(""))
    rows = pages.select(col(page_id).alias("page"), col(url).alias("url"), body.alias("html"), F.sha1(body.cast("binary")).alias("digest"))
    long_enough = rows.where(F.octet_length("html") >= min_bytes)
    repeated = long_enough.groupBy(F.col("digest").alias("same")).agg(F.max("page").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    led = rows.join(repeated, F.col("digest") == F.col("same"), "left")
    refers = F.when(~F.col("page").eqNullSafe(F.col("head")), F.col("head"))
    led = led.select(F.col("page").cast("string").alias("page"), "url", "html", refers.cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, done, records = None, "", 0, 0

        def listed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "records": records, "bytes": done}])

        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                page, url, text, refers_to = (c[i].as_py() for c in columns)
                if out is not None and done >= file_bytes:
                    yield listed()
                    out = None
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, records = store.open_output_stream(f"{base}/{name}", compression=None), 0
                    done = out.write(info())
                done += out.write(record(page, url, text.encode(), refers_to))
                records += 1
        if out is not None:
            yield listed()

    return saved(led.mapInArrow(run, MANIFEST), "manifest")


class Members:
    """Inflates a stream of gzip members, one after the other, a piece at a time."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.raw, self.ready, self.inflate = stream, b"", b"", None

    def open(self) -> bool:
        """Begin the next member; False at the end of the stream."""
        self.raw = self.raw or self.stream.read(PIECE)
        self.inflate, self.ready = zlib.decompressobj(31), b""
        return bool(self.raw)

    def more(self) -> bool:
        """Get another piece of the member; False at its end."""
        while not self.inflate.eof:
            self.raw = self.raw or self.stream.read(PIECE)
            if not self.raw:
                raise ValueError("archive ends within a record")
            try:
                piece = self.inflate.decompress(self.raw, PIECE)
            except zlib.error as e:
                raise ValueError(f"not a gzip member: {e}") from e
            self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if piece:
                self.ready += piece
                return True
        return False

    def until(self, end: bytes, limit: int | None = None) -> bytes:
        """Bytes up to and with `end`, within `limit` bytes."""
        seen = 0
        while (at := self.ready.find(end, max(0, seen - len(end)))) < 0:
            seen = len(self.ready)
            if limit is not None and seen > limit or not self.more():
                raise ValueError("record without an end to its header")
        found, self.ready = self.ready[: at + len(end)], self.ready[at + len(end) :]
        return found

    def take(self, n: int) -> Iterator[bytes]:
        """The next `n` bytes in pieces."""
        while n:
            if not self.ready and not self.more():
                raise ValueError("record shorter than its content length")
            piece, self.ready = self.ready[:n], self.ready[n:]
            n -= len(piece)
            yield piece

    def close(self) -> None:
        """The member must end with the record's own end."""
        while self.more():
            if len(self.ready) > len(END):
                break
        if self.ready != END:
            raise ValueError("record longer than its content length")


@dataclass
class Record:
    fields: dict[str, str]
    payload_bytes: int
    digest: str
    payload: bytes | None


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def records(stream: BinaryIO, payloads: bool = False) -> Iterator[Record]:
    """The records of an archive in sequence, digests verified; info records are left out."""
    members = Members(stream)
    while members.open():
        head = members.until(END)
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = header_fields(head)
        left = int(fields["content-length"])
        kind = fields["warc-type"]
        if kind not in ("response", "revisit"):
            for _ in members.take(left):
                pass
            members.close()
            continue
        http = members.until(END, left)
        left -= len(http)
        block, body, size, kept = hashlib.sha1(http), hashlib.sha1(), 0, []
        for piece in members.take(left):
            block.update(piece)
            body.update(piece)
            size += len(piece)
            if payloads:
                kept.append(piece)
        members.close()
        if fields["warc-block-digest"] != f"sha1:{base32(block.digest())}":
            raise ValueError(f"block digest differs in {fields['warc-record-id']}")
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and digest != base32(body.digest()):
            raise ValueError(f"payload digest differs in {fields['warc-record-id']}")
        told = int(header_fields(http)["content-length"])
        if kind == "response" and told != size:
            raise ValueError(f"payload length differs in {fields['warc-record-id']}")
        yield Record(fields, told, digest, b"".join(kept) if payloads and kind == "response" else None)


def read(manifest: DataFrame, *, id_type: str = "bigint", payloads: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]) of every record in the listed archives."""
    schema = pa.schema([
        ("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.string()), *[("payload", pa.binary())] * payloads,
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = pyarrow.fs.FileSystem.from_uri(path)
                with store.open_input_stream(place, compression=None) as stream:
                    rows, held = [], 0
                    for r in records(stream, payloads):
                        f = r.fields
                        row = (f.get("x-page-id"), f["warc-target-uri"], r.payload_bytes, r.digest, f["warc-type"], f.get("x-refers-to-page-id"), r.payload)
                        rows.append(dict(zip(schema.names, row)))
                        held += len(r.payload or b"")
                        if len(rows) == 5000 or held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    text = "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string" + ", payload binary" * payloads
    # One task per archive, whatever the size of the manifest's rows.
    found = manifest.select("path").repartition(max(1, manifest.count())).mapInArrow(run, text)
    return found.withColumns({"page_id": F.col("page_id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})
