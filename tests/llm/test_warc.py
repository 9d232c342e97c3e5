import base64
import gzip
import hashlib
import io
import os

import pytest

from samples import pick
from weirstone.llm import warc as W

PAGES = "page_id long, url string, html string, digest string, head long, n int"


def rows():
    same = "<p>same é</p>"
    out = [(i, f"http://h/{i}", same if i % 3 == 0 else f"<p>{i}</p>", "x", 1, 1) for i in range(30)]
    out += [(100, None, None, "x", 1, 1), (101, "http://e", "", "x", 1, 1), (None, "http://n", same, "x", 1, 1), (None, "http://only", "only me", "x", 1, 1)]
    out += [(200, "http://x/\r\nWARC-Type: evil é", "a\r\n\r\nb", "x", 1, 1), (201, "http://long", "z" * 3_000_000, "x", 1, 1), (27, "http://again", same, "x", 1, 1)]
    return out


def brute(pages, min_bytes=0):
    coded = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    heads = {}
    for p, _, html, *_ in pages:
        if p is not None:
            heads[html or ""] = max(p, heads.get(html or "", p))
    out = []
    for p, _, html, *_ in pages:
        text = html or ""
        head = heads.get(text)
        again = len(text.encode()) >= min_bytes and head is not None and p != head
        out.append((p, len(text.encode()), coded(text), "revisit" if again else "response", head if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
@pytest.mark.parametrize("file_bytes", [W.FILE_BYTES, 300])
def test_write_and_read(spark, folder, min_bytes, file_bytes):
    pages = rows()
    manifest = W.write(spark.createDataFrame(pages, PAGES).repartition(3), f"{folder}/warc", min_bytes=min_bytes, file_bytes=file_bytes)
    assert manifest.count() >= (1 if file_bytes == W.FILE_BYTES else 8)
    got = W.read(manifest)
    assert pick(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == brute(pages, min_bytes)


def test_payloads_come_back(spark, folder):
    pages = rows()
    got = W.read(W.write(spark.createDataFrame(pages, PAGES), f"{folder}/warc"), payloads=True).where("record_type = 'response'").collect()
    assert {r["payload"].decode() for r in got} == {p[2] or "" for p in pages}


def test_one_member_per_record(spark, folder):
    manifest = W.write(spark.createDataFrame(rows()[:5], PAGES).coalesce(1), f"{folder}/warc")
    raw = open(manifest.first()["path"].removeprefix("file://"), "rb").read()
    assert raw.count(b"\x1f\x8b\x08") == 6  # with the info record
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == 6


def test_leftovers_of_other_attempts_do_not_count(spark, folder):
    manifest = W.write(spark.createDataFrame(rows(), PAGES), f"{folder}/warc")
    with open(f"{folder}/warc/stray.warc.gz", "wb") as out:
        out.write(b"junk")
    assert W.read(manifest).count() == len(rows())


def broken(change):
    data = bytearray(gzip.decompress(W.record("1", "http://a", b"payload " * 50, None)))
    return W.member(bytes(change(data)))


@pytest.mark.parametrize(
    "raw",
    [
        W.record("1", "u", b"x" * 9000, None)[:-20], b"plain text, no gzip", broken(lambda d: d.replace(b"payload", b"PAYLOAD", 1)),
        broken(lambda d: d[:-30]), broken(lambda d: d + b"more"), broken(lambda d: d.replace(b"Content-Length: 400", b"Content-Length: 401")),
    ],
)
def test_damage_is_found(raw):
    with pytest.raises(ValueError):
        list(W.records(io.BytesIO(W.record("0", "u", b"fine", None) + raw)))


def test_small_pieces():
    """Members that end anywhere within what is read at a time."""
    one = b"".join(W.record(str(i), "u", os.urandom(i * 997), None) for i in range(40))

    class Drip(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, 37))

    assert [r.payload_bytes for r in W.records(Drip(one))] == [i * 997 for i in range(40)]


def test_empty(spark, folder):
    assert W.read(W.write(spark.createDataFrame([], PAGES), f"{folder}/warc")).count() == 0
