import random

import pytest

from samples import corpus, frame, pick, words
from weirstone.llm import linededup as L


def brute(docs, min_words=50):
    """Lines inside a run of `min_words` words that stands earlier, by comparing all line ranges."""
    order = sorted((r for r in docs if r[1] is not None), key=lambda r: (r[0] is not None, r[0] or 0))
    ranges = {}
    split = [[x.strip() for x in r[1].split("\n")] for r in order]
    gone = []
    for d, lines in enumerate(split):
        hit = set()
        for i in range(len(lines)):
            n = 0
            for j in range(i, len(lines)):
                n += len(lines[j].split())
                if n >= min_words:
                    body = tuple(lines[i : j + 1])
                    d0, j0 = ranges.setdefault(body, (d, j))
                    if d0 != d or i > j0:
                        hit |= set(range(i, j + 1))
        gone.append(hit)
    return [(r[0], "\n".join(x for k, x in enumerate(r[1].split("\n")) if k not in h)) for r, h in zip(order, gone)]


def planted():
    rng = random.Random(8)
    passage = [" ".join(words(rng, k, 5000)) for k in (20, 5, 31)]
    short = " ".join(words(rng, 30, 5000))
    rows = []
    for i in range(25):
        own = [" ".join(words(rng, rng.randrange(3, 30), 5000)) for _ in range(6)]
        at = rng.randrange(6)
        rows.append((i, "\n".join([*own[:at], *(passage if i % 2 else [short]), *own[at:]]), "en", "s", 1))
    rows.append((40, "\n".join(["spam spam"] * 120), "en", "s", 1))
    rows.append((41, "\n".join([*passage, "own line", *passage, *passage]), "en", "s", 1))
    return rows


def test_planted_passages(spark):
    docs = planted()
    got = pick(L.report(frame(spark, docs, extra=True)), "doc_id", "kept")
    assert got == sorted(brute(docs), key=str)


def test_cases(spark):
    """Copies, nulls, empties, a long text; repeated rows keep the same lines."""
    docs = corpus()
    got = {(r["doc_id"], r["kept"]) for r in L.report(frame(spark, docs)).collect()}
    once = list(dict.fromkeys(docs))
    assert got == {*brute(once), *((r[0], None) for r in once if r[1] is None)}


def test_dedup_drops_what_is_mostly_repeated(spark):
    docs = corpus()
    df = frame(spark, docs, extra=True)
    out = L.dedup(df)
    assert out.columns == df.columns
    ids = [r["doc_id"] for r in out.collect()]
    copies = {r[0] for r in docs if r[0] is not None and 60 <= r[0] < 65}
    long_enough = len(docs[4][1].split()) >= 50
    assert not copies & set(ids) if long_enough else copies <= set(ids)
    assert 7 in ids and ids.count(7) == 3 and None in ids


def test_empty(spark):
    assert L.report(frame(spark, [])).count() == 0 and L.dedup(frame(spark, [])).count() == 0


def test_dedup_keeps_the_words_that_stand_nowhere_else(spark):
    rng = random.Random(6)
    shared, own = " ".join(words(rng, 60, 5000)), " ".join(words(rng, 15, 5000))
    docs = [(1, shared, "en", "s", 1), (2, f"{own}\n{shared}", "en", "s", 1), (3, f"{shared}\none", "en", "s", 1), (4, f"{shared}\n\n {shared}", "en", "s", 1)]
    assert pick(L.dedup(frame(spark, docs, extra=True)), "doc_id", "text") == [(1, shared), (2, own), (3, "one")]


def test_fewer_fingerprints_than_lines(spark):
    docs = corpus()
    found = L.fingerprints(frame(spark, docs)).collect()
    lines = sum(len(r[1].split("\n")) for r in docs if r[1])
    assert 0 < len(found) < lines / 2
    windows = sum(len(r["near"]) // 8 for r in found)
    assert windows > len(found)


def common_lines(seed):
    """Passages put together from few lines, empty ones too, so that a fingerprint stands in many contexts."""
    rng = random.Random(seed)
    lines = [" ".join(words(rng, rng.randrange(1, 9), 5000)) for _ in range(12)] + ["", " \t"]
    blocks = [[rng.choice(lines) for _ in range(rng.randrange(5, 30))] for _ in range(6)]
    rows = []
    for i in range(40):
        body = [x for _ in range(rng.randrange(1, 5)) for x in rng.choice(blocks)]
        rows.append((i, "\n".join(body), "en", "s", 1))
    rows.append((90, "\n".join(["again and again"] * 200 + [""] * 300 + ["again"] * 70), "en", "s", 1))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_a_common_line_in_many_passages(spark, seed):
    docs = common_lines(seed)
    got = pick(L.report(frame(spark, docs)), "doc_id", "kept")
    assert got == sorted(brute(docs), key=str)


def test_a_repeat_of_a_later_position(spark):
    """The fingerprint's first position stands in another passage than the one that repeats."""
    rng = random.Random(1)
    lines = [" ".join(words(rng, 20, 9000)) for _ in range(9)]
    marks = L.text_fingerprints([("\n".join(lines)).encode()], 50)
    common = lines[marks[1][len(marks[1]) // 2][1][0]]
    other = [x for x in lines if x != common]
    passage = [*other[:2], common, *other[2:4]]
    docs = [(1, "\n".join([*other[4:6], common, *other[6:]]), "en", "s", 1)] + [(i, "\n".join(passage), "en", "s", 1) for i in (2, 3, 4)]
    assert pick(L.report(frame(spark, docs)), "doc_id", "kept") == sorted(brute(docs), key=str)
    assert [r["removed_words"] for r in L.report(frame(spark, docs)).orderBy("doc_id").collect()] == [0, 0, 100, 100]


def test_a_very_long_text():
    text = "\n".join("a" for _ in range(100_000)).encode() + b"\n" * 100_000
    fps, rows = L.text_fingerprints([text, b"", b"\n"], 50)
    assert len(rows) == len(fps) < 200 and sum(len(r[1]) for r in rows) > 90_000
