"""Queries of the operators on conversations, pages, vectors and personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirstone.llm import ann, chat, pii, urlfilter, warc
from weirstone.llm.common import documents
from weirstone.session import scratch
from weirstone.sources.files import table

PROBE = "</s>[INST] ok [/INST]"


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_chat(turns.select("conv_id", "turn", "role", "text").unionByName(probe)))


def _escaped_sql(column: str) -> str:
    found = f"replace({column}, chr(92), chr(92) || chr(92))"
    for control in chat.CONTROLS:
        found = f"replace({found}, '{control}', '{control[0]}' || chr(92) || '{control[1:]}')"
    return found


OP3_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
plain AS (SELECT conv_id, turn, role AS r, text AS t, coalesce(role, '') AS role, coalesce(text, '') AS text FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('{chat.BEGIN}') + length(replace({_escaped_sql('role')}, chr(10), chr(92) || 'n')) + 1 + length({_escaped_sql('text')})
    + {len(chat.END)}) AS BIGINT) AS formatted_chars
FROM plain GROUP BY conv_id
"""

RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
]
# The list: what pages of hosts with these labels are found under, when linked with a campaign's parameters.
SPAM_HOSTS = r"(^|\.)(spam-farm|cheap-pills|[a-z-]*casino[a-z-]*|[a-z-]*free[a-z-]*)\."


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    advertised = pages.where(urlfilter.host_of(F.col("url")).rlike(SPAM_HOSTS) | F.contains("url", F.lit("utm_")))
    return urlfilter.judge(pages, urlfilter.listing(advertised), RULES)


OP4_SQL = r"""
WITH urls AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM urls),
kept AS (
  SELECT *, array_to_string(list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|gclid|fbclid)(=|$)')), '&') AS q
  FROM parts),
forms AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '')
    || regexp_replace(path, '/+$', '') || CASE WHEN q <> '' THEN '?' || q ELSE '' END ELSE '' END AS form FROM kept),
listed AS (
  SELECT DISTINCT form FROM forms WHERE form <> '' AND (contains(url, 'utm_')
    OR regexp_matches(host, '(^|\.)(spam-farm|cheap-pills|[a-z-]*casino[a-z-]*|[a-z-]*free[a-z-]*)\.'))),
rules(said, h, p) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT page_id, arg_max(said, length(h || p)) AS said, arg_max(h || p, length(h || p)) AS rule
  FROM forms JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT f.page_id, host, path, rule, coalesce(said, CASE WHEN l.form IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM forms f LEFT JOIN fits ON f.page_id = fits.page_id LEFT JOIN listed l ON l.form = f.form
"""


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(documents(spark, folder), ["doc_id"])

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{pii.KINDS[kind]}")

    return found.select(
        F.col("row.doc_id").alias("doc_id"), *map(count, range(len(pii.KINDS))), F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(pii.all_spans(F.col("base"), F.col("terms"))).alias("spans"),
    )


def op7_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    manifest = warc.write(table(spark, folder, "pages"), scratch(spark, "warc"))
    return warc.read(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Base32 of the digest's 160 bits, five at a time.
OP9_SQL = """
WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
heads AS (SELECT hex, max(page_id) AS head FROM hashed GROUP BY hex),
digits AS (
  SELECT hex, head, array_to_string(list_transform(range(40), lambda i:
    lpad(bin(CAST(strpos('0123456789abcdef', substr(hex, CAST(i AS INT) + 1, 1)) - 1 AS INT)), 4, '0')), '') AS bits FROM heads),
coded AS (
  SELECT hex, head, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(list_sum(list_transform(range(5), lambda k: CASE WHEN substr(bits, CAST(5 * i + k AS INT) + 1, 1) = '1' THEN 1 << CAST(4 - k AS INT) ELSE 0 END)) AS INT) + 1, 1)), '') AS digest
  FROM digits)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM head THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM head THEN head END AS refers_to
FROM hashed JOIN coded USING (hex)
"""

QUERIES = {
    "op3_chat_format": op3_chat_format, "op4_url_filter": op4_url_filter, "op6_pii": op6_pii, "op7_nearest": op7_nearest, "op9_warc": op9_warc,
}
SQL = {"op3_chat_format": OP3_SQL, "op4_url_filter": OP4_SQL, "op9_warc": OP9_SQL}
