import re

from samples import pick
from weirstone.llm import urlfilter as U
from weirstone.llm.q_records import RULES

PAGES = "page_id long, url string, host int, block int, listed string, verdict string"
URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com", "http://example.com/", "https://www.example.com/en/x", "https://m.example.com/en/", "http://example.com/en",
    "http://badexample.com/en/", "http://example.net/es/1", "http://a.b.net/fr/?q", "http://x.net/FR/", "http://spam.org/a/?utm_source=1&b=2#f", "http://www.spam.org:80/a?b=2",
    "http://spam.org/b", "http://spam.org/a?b=2&ref=9", "http://ok.org?x#y", "http://ok.org#y?x", "a://b://c/d", "http://ÉX.org/é", "http://host\n/line", "http://spam.org/a/b" + "c" * 100_000,
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def canonical(url):
    host, path = parts(url)
    if not host:
        return ""
    query = re.match(r"[^?#]*\??([^#]*)", url.split("://", 1)[1])
    query = query[1] if "?" in url.split("://", 1)[1].split("#")[0] else ""
    kept = "&".join(p for p in query.split("&") if p and not re.match(r"(utm_[a-z]+|ref|gclid|fbclid)(=|$)", p))
    return re.sub(r"^www\.", "", re.sub(r":(80|443)$", "", host)) + re.sub("/+$", "", path) + ("?" + kept if kept else "")


def brute(rows, listed, rules):
    out = []
    for page, url, *_ in rows:
        host, path = parts(url)
        fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fit, key=lambda r: (len(r[1] + r[2]), len(r[1])), default=None)
        hit = canonical(url) in listed and canonical(url) != ""
        out.append((page, host, path, best and best[1] + best[2], best[0] if best else "block" if hit else "allow"))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rows = [(i, u, 1, 1, "x", "x") for i, u in enumerate(URLS)] + [(13, URLS[13], 1, 1, "x", "x"), (None, URLS[15], 1, 1, "x", "x")]
    rows += [(1000 + i, f"http://h{i % 50}.org/p{i}", 1, 1, "x", "x") for i in range(600)]
    source = ["http://spam.org/a?b=2", None, "", "http://spam.org/a?b=2", *(f"https://www.h{i % 50}.org/p{i}/" for i in range(0, 600, 7))]
    pages = spark.createDataFrame(rows, PAGES)
    listed = U.listing(spark.createDataFrame([(u,) for u in source], "url string"))
    got = U.judge(pages, listed, RULES)
    assert pick(got, "page_id", "host", "path", "rule", "verdict") == brute(rows, {canonical(u) for u in source}, RULES)
    assert "ArrowEval" not in got._jdf.queryExecution().executedPlan().toString()


def test_filter_has_no_false_negative_and_few_false_positives(spark):
    from pyspark.sql import functions as F

    listed = spark.range(4000).select(F.concat(F.lit("h.org/"), "id").alias("listed"))
    blocks = 4000 * U.BITS_PER_URL // 512
    table = U.bloom(listed, blocks)
    probes = spark.range(12_000).select("id", *U.positions(F.concat(F.lit("h.org/"), "id"), blocks)).join(table, "block", "left")
    hit = F.lit(True)
    for i in range(U.LANES):
        hit = hit & (F.expr(f"shiftright(lane{i}, bit{i}) & 1L") == 1)
    seen = probes.where(hit)
    assert seen.where("id < 4000").count() == 4000 and seen.where("id >= 4000").count() < 80


def test_empty(spark):
    none = spark.createDataFrame([], "url string")
    assert U.judge(spark.createDataFrame([], PAGES), U.listing(none), RULES).count() == 0
    pages = spark.createDataFrame([(1, "http://a.org/x", 1, 1, "x", "x")], PAGES)
    assert pick(U.judge(pages, U.listing(none)), "page_id", "rule", "verdict") == [(1, None, "allow")]
