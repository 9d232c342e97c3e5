import re

import pytest

from samples import corpus, frame, pick
from weirstone.llm import decontaminate as D

BENCH = "item_id long, text string"


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, bench):
    windows = []
    for item, text in bench:
        ws = tokens(text)
        windows += [(ws[i : i + 10], item) for i in range(max(1, len(ws) - 9))] if ws else []
    out = []
    for row in docs:
        ws, hit, items = tokens(row[1]), set(), set()
        for w, item in windows:
            for i in range(len(ws) - len(w) + 1):
                if ws[i : i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    items |= {str(item)} if item is not None else set()
        out.append((row[0], len(ws), len(hit), len(items), sorted(items), bool(hit)))
    return sorted(out, key=str)


def cases():
    docs = [r for r in corpus() if r[1] is None or len(r[1]) < 5000]
    first = docs[0][1].replace("\n", " ").split()
    bench = [
        (1, docs[3][1]), (2, " ".join(first[2:14]).upper()), (3, "w1 w2"), (4, None), (5, "!!"), (None, docs[5][1]), (1, docs[3][1]), (6, "É ẞ straße"),
        (7, docs[3][1]),
    ]
    return [*docs, (900, "x É, straße; É ẞ straße É y", "de", "s", 3)], bench


@pytest.mark.parametrize("block", [D.BLOCK, 7])
def test_find(spark, block):
    docs, bench = cases()
    found = D.find(frame(spark, docs, extra=True), spark.createDataFrame(bench, BENCH), block=block)
    assert pick(found, "doc_id", "n_words", "n_hit", "n_items", "items", "contaminated") == brute(docs, bench)


@pytest.mark.parametrize("block", [D.BLOCK, 7])
def test_decontaminate_leaves_no_window_and_clean_texts_alone(spark, block):
    docs, bench = cases()
    plain = " ".join(f"a{i}" for i in range(40))
    passage = " ".join(docs[3][1].replace("\n", " ").split()[:12])
    # Cutting the inner passage brings the two halves of another one together.
    docs += [(950, f"{plain} {passage}. {plain}", "en", "s", 1), (951, passage, "en", "s", 1), (952, f"{plain} w1 w1 w2 w2 {plain}", "en", "s", 1)]
    df, items = frame(spark, docs, extra=True), spark.createDataFrame(bench, BENCH)
    kept = D.decontaminate(df, items, block=block)
    assert kept.columns == df.columns
    assert D.find(kept, items).where("contaminated").count() == 0
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert 951 not in texts and texts[950].replace(".", "").split() == [*plain.split(), *plain.split()]
    assert "w1 w2" not in texts[952]
    clean = {r[0]: r[1] for r in docs} | {None: "no id here"}
    for row in brute(docs, bench):
        if not row[5]:
            assert texts[row[0]] == clean[row[0]]


def test_empty_tables(spark):
    docs, bench = frame(spark, []), spark.createDataFrame([], BENCH)
    assert D.find(docs, bench).count() == 0
    some = frame(spark, corpus()[:3])
    assert pick(D.decontaminate(some, bench), "doc_id", "text") == pick(some, "doc_id", "text")
