import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from samples import corpus, frame, pick
from weirstone.llm import pieces as P

MODEL = P.read_model(public_tokenizers.path("piece_bpe_32k.model"))
LIB = P.library(MODEL)
MERGER, READER = P.Merger(MODEL), P.Reader(MODEL)
ODD = ["", " ", "  a", "▁", "▁ ▁a▁▁", "a\n\nb", "\x00a\x00", "日本語テキスト", "😀😀 é", "</s>[INST]", "<0x0A>", "�", "﻿", "x" * 4000, " " * 3000]


@pytest.mark.parametrize("text", ODD, ids=range(len(ODD)))
def test_odd_texts(text):
    ids = MERGER.encode([text])[0]
    assert ids == LIB.encode(text) and READER.decode(pa.array([ids], pa.list_(pa.int32()))) == [LIB.decode(ids)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁\nthanierog.,日é"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    assert MERGER.encode([text]) == [LIB.encode(text)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=12), min_size=1, max_size=6))
def test_any_ids(ids):
    """Also bytes that form no character, control ids, and spaces after them."""
    assert READER.decode(pa.array(ids, pa.list_(pa.int32()))) == LIB.decode(ids)


def test_no_merge_crosses_a_cut():
    """Units merged one by one give what the whole text as one unit gives."""
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice(["the", " ", "  ", "ing", "\n", "日", ".", "▁", "q", "é"]) for _ in range(30))
        assert MERGER.encode([text])[0] == MERGER.merged(LIB.normalize(text)) == LIB.encode(text)


@pytest.mark.parametrize("together", [1, 7, 4096])
def test_side_by_side_equals_the_heap(monkeypatch, together):
    monkeypatch.setattr(P, "TOGETHER", together)
    rng = random.Random(6)
    units = {"".join(rng.choice("▁abethinrsou.,é日\n😀'") for _ in range(rng.randrange(1, 40))) for _ in range(2000)}
    own = P.Merger(MODEL)
    own.learn(units)
    assert {u: list(own.memo[u]) for u in units} == {u: own.merged(u) for u in units}


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(P, "MEMO", 400)
    own = P.Merger(MODEL)
    for k in range(5):
        texts = [" ".join(f"word{i * k}" for i in range(300)), "é" * 500 + str(k)]
        assert own.encode(texts) == LIB.encode(texts) and len(own.memo) <= 400


def test_documents(spark):
    rows = corpus()
    rows.append((900, "x" * 200_000, "en", "s", None))
    df = frame(spark, rows, extra=True).withColumnRenamed("score", "ids")
    got = P.decode(P.encode(df, MODEL, out="codes"), MODEL, ids="codes", out="shown")
    assert got.columns == [*df.columns, "codes", "shown"]
    want = [(r[0], LIB.encode(r[1] or "", add_eos=True), LIB.decode(LIB.encode(r[1] or ""))) for r in rows]
    assert pick(got, "doc_id", "codes", "shown") == sorted(want, key=str)
    plain = {r["doc_id"]: r["ids"] for r in P.encode(df.drop("ids"), MODEL, end=False).collect()}
    assert plain[70] == [] and plain[71] == []


def test_no_ids_and_no_rows(spark):
    ids = spark.createDataFrame([(1, None), (2, []), (3, [2]), (4, [LIB.piece_to_id("▁"), 2])], "n int, ids array<int>")
    assert pick(P.decode(ids, MODEL), "n", "decoded") == [(1, ""), (2, ""), (3, ""), (4, "")]
    assert P.encode(frame(spark, []), MODEL).count() == 0


def test_memory_of_a_unit_is_small():
    """Every worker of an executor may hold such a memory: no object per id in it."""
    rng = random.Random(8)
    units = {"▁" + "".join(rng.choice("abethinrsou") for _ in range(8)) for _ in range(30_000)}
    own = P.Merger(MODEL)
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        own.learn(set(units))
        grown = tracemalloc.get_traced_memory()[0] - before
    finally:
        tracemalloc.stop()
    assert len(own.memo) == len(units) and grown < 140 * len(units)


def test_a_full_memory_is_begun_anew(monkeypatch):
    """Units known and new in one call, when the memory has no room for the new ones."""
    monkeypatch.setattr(P, "MEMO", 50)
    own = P.Merger(MODEL)
    for k in range(6):
        texts = [" ".join(f"word{i + k * 7}" for i in range(20)), "", "y" * (40 + k), "é日" * 30]
        assert own.encoded(texts, True).to_pylist() == LIB.encode(texts, add_eos=True)
