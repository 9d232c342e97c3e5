"""URL filter: rules first, then a list of canonical URLs behind a blocked Bloom filter.

DataFrame functions only. The filter is a table of blocks, each of eight 64-bit lanes; a
listed URL sets one bit in every lane of the one block that its hash names. A page's URL
is looked up in its block by an equi-join, and only possible hits go on to the exact join
with the list, which removes the false positives. Spark broadcasts the blocks where they
are small; else they are joined by block number, at any size of the list. No page is
grouped: both joins keep pages on the side that can be split.

A rule is (verdict, host, path): it fits its host and all subdomains, if the page's path
starts with the rule's. The longest host and path win; of two equally long ones the
longer host. Rules decide before the list.

Canonical form: host without a leading `www.`, path without slashes at its end, query
without tracking parameters; scheme, port 80 or 443 and fragment are left out.

Defined cases: a null url or one without `://` has empty host and path, fits no rule, is
never listed and is allowed. Repeated pages are judged one by one; repeated or null list
entries count once or not at all. An empty list blocks nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weirstone.llm.common import col, saved

Rule = tuple[str, str, str]

LANES, LANE_BITS = 8, 64
BITS_PER_URL = 16
TRACKING = r"^(utm_[a-z]+|ref|gclid|fbclid)(=|$)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    before = F.substring_index(url, "://", 1)
    return F.when(F.contains(url, F.lit("://")), F.substring(url, F.length(before) + 4, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """The form in which URLs are listed; empty for what has no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^www\.", "")
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    return F.when(host != "", F.concat(host, F.regexp_replace(path_of(url), r"/+$", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))))\
        .otherwise(F.lit(""))


def listing(urls: DataFrame, url: str = "url") -> DataFrame:
    """Distinct canonical forms of a column of URLs."""
    return urls.select(canonical(col(url)).alias("listed")).where("listed <> ''").distinct()


def positions(value: Column, blocks: int) -> list[Column]:
    """Block number, and the bit of each lane."""
    bits = F.xxhash64(value, F.lit("lanes"))
    return [F.pmod(F.xxhash64(value), F.lit(blocks)).alias("block"), *[
        F.shiftright(bits, 6 * i).bitwiseAND(F.lit(LANE_BITS - 1)).cast("int").alias(f"bit{i}") for i in range(LANES)
    ]]


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, lane0 .. lane7) with the bits of all listed URLs."""
    marked = listed.select(*positions(F.col("listed"), blocks))
    return marked.groupBy("block").agg(*[F.bit_or(F.expr(f"shiftleft(1L, bit{i})")).alias(f"lane{i}") for i in range(LANES)])


def fitting(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Verdict and name of the rule that wins, or nulls."""
    verdict = name = F.lit(None).cast("string")
    for said, of, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == of) | F.endswith(host, F.lit("." + of))) & F.startswith(path, F.lit(start))
        verdict, name = F.when(fits, F.lit(said)).otherwise(verdict), F.when(fits, F.lit(of + start)).otherwise(name)
    return verdict, name


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (), *, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page; `listed` comes from `listing`."""
    listed = saved(listed, "listed")
    blocks = max(1, -(-listed.count() * BITS_PER_URL // (LANES * LANE_BITS)))
    parts = pages.select(col(page_id).alias("page_id"), host_of(col(url)).alias("host"), path_of(col(url)).alias("path"), canonical(col(url)).alias("value"))
    parts = parts.select("page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.coalesce("value", F.lit("")).alias("value"))
    verdict, name = fitting(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": name, "verdict": verdict})
    open_ = F.col("rule").isNull() & (F.col("value") != "")
    told = parts.where(~open_).withColumn("verdict", F.coalesce("verdict", F.lit("allow")))
    probes = parts.where(open_).select("page_id", "host", "path", "rule", "value", *positions(F.col("value"), blocks))
    hit = F.lit(True)
    for i in range(LANES):
        hit = hit & (F.expr(f"shiftright(lane{i}, bit{i}) & 1L") == 1)
    looked = probes.join(bloom(listed, blocks), "block", "left").withColumn("maybe", F.coalesce(hit, F.lit(False)))
    passed = looked.where(~F.col("maybe")).withColumn("verdict", F.lit("allow"))
    exact = looked.where("maybe").join(listed, F.col("value") == F.col("listed"), "left")
    exact = exact.withColumn("verdict", F.when(F.col("listed").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    shown = ["page_id", "host", "path", "rule", "verdict"]
    return told.select(*shown).unionByName(passed.select(*shown)).unionByName(exact.select(*shown))
