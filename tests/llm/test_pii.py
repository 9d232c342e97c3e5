import random
import re

from pyspark.sql import functions as F

from samples import corpus, frame, pick
from weirstone.llm import pii as P

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]
TEXTS = [
    "a@b.co_x@d.ef", "a@b@c.de", "a@b.c.", "x@y", "@a.b", "é.a@b.c𝄞 +1 (743) 555-3824.", "1.2.3.4.5 256.1.1.1 0255.01.1.001", "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112",
    "41111111111111111111111", "+1234567", "+12 345 678 9-", "+1+1234567890", "12 34-56", "a.b@c.d,e@f.g;h@i.j", "9" * 3000, "a" * 3000 + "@b.c", "a." * 1500, "1." * 1500, "%+-._@-.-",
    "tel +49 (0) 30 1234567 and 10.0.0.1@x.y", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "x\n1.1.1.1\n+1 555 123 4567\n", "+1" + "(" * 2000 + "2", "a@b.c" * 40,
]


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        worth = [int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(worth) % 10 == 0
    return 9 <= len(digits) <= 15 if kind == "phone" else True


def base(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS for m in re.finditer(p, text or "") if passes(k, m[0]))


def spans(df):
    found = P.find(df, ["doc_id"])
    return pick(found.select("row.doc_id", P.listed(F.col("base")).alias("base")), "doc_id", "base")


def test_direct_identifiers(spark):
    rng = random.Random(4)
    random_texts = ["".join(rng.choice("0123456789.@+-() ab_é") for _ in range(rng.randrange(60))) for _ in range(500)]
    rows = [*corpus(10), *((1000 + i, t, "en", "s", 1) for i, t in enumerate(TEXTS + random_texts))]
    assert spans(frame(spark, rows, extra=True)) == sorted(((r[0], base(r[1])) for r in rows), key=str)


def test_many_matches_in_one_text(spark):
    text = " ".join(f"u{i}@m{i}.org" for i in range(1000))
    assert spans(frame(spark, [(1, text, "en", "s", 1)])) == [(1, base(text))]


def disclosure():
    """Corpus of 300 plain texts and a few with identifiers."""
    rows = [(i, f"hello word{i} and other{i % 7} things. Said often{i % 3} here.", "en", "s", 1) for i in range(300)]
    far = "and " * 40
    rows += [
        # In one document: rare words of its sentence, also far from it and in another sentence; not those of the next sentence.
        (500, f"Quibble {far} wrote to boss@corp.example hello things. Nextword stands alone. Again quibble.", "en", "s", 1),
        # In two documents and two sentences: `zorp` and `flimp` are known for it, wherever they stand.
        (510, "The zorp flimp called +1 555 123 4567 hello.", "en", "s", 1),
        (511, "A zorp, a flimp: +1 (555) 123-4567 again things.", "en", "s", 1),
        (512, "Nobody called, but zorp was here. Hello things.", "en", "s", 1),
    ]
    rows += [(600 + i, "Copied snark by ann@corp.example here.", "en", "s", 1) for i in range(6)]
    rows.append((620, "A snark without its name.", "en", "s", 1))
    return rows


def found_terms(df, **options):
    found = P.find(df, ["doc_id", "text"], **options).where("size(terms) > 0").collect()
    return sorted({(r["row"]["doc_id"], r["row"]["text"][s["start"] : s["end"]].lower()) for r in found for s in r["terms"]})


def brute_terms(rows, support=P.SUPPORT, threshold=P.THRESHOLD):
    n = len(rows)
    words = [set(re.findall(r"[^\W_]+", (r[1] or "").lower())) for r in rows]
    n_t = lambda t: sum(t in w for w in words)
    near, holders = {}, {}
    for i, r in enumerate(rows):
        text = r[1] or ""
        spans = [(m.start(), m.end(), re.sub("[^0-9]", "", m[0]) if k in ("card", "phone") else m[0].lower()) for k, p in PATTERNS for m in re.finditer(p, text) if passes(k, m[0])]
        ends = [0, *(m.end() for m in re.finditer(r"[.!?]\s|\n", text)), len(text)]
        for a, b, e in spans:
            first, last = max(x for x in ends if x <= a), min(x for x in ends if x >= b)
            holders.setdefault(e, set()).add(i)
            for m in re.finditer(r"[^\W_]+", text[first:last]):
                if len(m[0]) >= 3 and not any(first + m.start() < y and first + m.end() > x for x, y, _ in spans):
                    near.setdefault((e, m[0].lower()), []).append((i, text[first:last].rstrip(".!? ")))
    out = set()
    for (e, t), places in near.items():
        n_e, n_et = len(holders[e]), len({i for i, _ in places})
        if n_et * n / (n_e * (n_t(t) + 0.5)) >= (n / n_e) ** threshold:
            wide = len({c for _, c in places}) >= support
            out |= {(rows[i][0], t) for i in range(n) if t in words[i] and (wide or i in {j for j, _ in places})}
    return sorted(out)


def test_disclosing_terms(spark):
    rows = disclosure()
    found = found_terms(frame(spark, rows, extra=True).repartition(3))
    assert found == brute_terms(rows)
    of = lambda i: {t for j, t in found if j == i}
    assert of(500) == {"quibble", "wrote"} and {"zorp", "flimp"} <= of(510) & of(511) and of(512) == {"zorp"}
    # Copies are one sentence: no evidence for other documents.
    assert "snark" in of(600) and not of(620)
    assert not any(t in ("hello", "things", "and") for _, t in found) and not any(j < 500 for j, _ in found)
    text = rows[300][1]
    row = P.find(frame(spark, rows), ["doc_id"]).where("row.doc_id = 500").first()
    assert [text[s["start"] : s["end"]] for s in row["terms"]] == ["Quibble", "wrote", "quibble"] and row["terms"][0]["end"] + 61 < row["base"][0]["start"]


def test_long_sentences_have_a_width(spark):
    rows = [(i, f"plain text and number{i}", "en", "s", 1) for i in range(300)]
    rows.append((900, "outside " + "and " * 200 + "inside a@b.org", "en", "s", 1))
    assert found_terms(frame(spark, rows)) == [(900, "inside")]


def test_sanitise(spark):
    rows = [*disclosure(), (900, None, None, None, None), (901, "", "en", "s", 0), (None, "and a@b.org, hello +1 555 123 0067!", "en", "s", 1), (902, "and 4111 1111 1111 1111 hello 1.2.3.4", "en", "s", 1)]
    df = frame(spark, rows, extra=True)
    out = P.sanitise(df)
    assert out.columns == df.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[900] is None and texts[901] == "" and texts[None] == "and [EMAIL], hello [PHONE]!" and texts[902] == "and [CARD] hello [IP]"
    assert texts[512] == "Nobody called, but [TERM] was here. Hello things." and texts[0] == rows[0][1] and texts[620] == "A snark without its name."
    assert texts[600] == "[TERM] [TERM] by [EMAIL] here."


def test_empty(spark):
    assert P.find(frame(spark, []), ["doc_id"]).count() == 0 and P.sanitise(frame(spark, [])).count() == 0
