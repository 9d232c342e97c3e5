"""Queries of the operators that judge, clean or mix documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirstone.llm import decontaminate, linededup, mixing, quality, simhash
from weirstone.llm.common import documents
from weirstone.sources.files import table


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find(documents(spark, folder), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[i:i + 9], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM items WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT k FROM wins),
spots AS (
  SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM words, sizes WHERE len(ws) >= k)),
hits AS (SELECT doc_id, i, spots.k AS k, item_id FROM spots JOIN wins USING (win)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.plan(documents(spark, folder))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


# The targets in closed form: the sources with the least limit per weight are limited,
# as many as the rate of the others then demands.
OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 13) AS BIGINT) + 1)
      / 4503599627370496.0::DOUBLE AS u,
    CASE WHEN length(text) > 0 THEN greatest(1.0::DOUBLE - 10.0::DOUBLE * CAST(length(text)
      - length(regexp_replace(text, '[#$%&*<=>\[\\\]^_{|}~]', '', 'g')) AS DOUBLE) / length(text), 0.1::DOUBLE) ELSE 0.1::DOUBLE END AS q
  FROM documents),
keyed AS (SELECT *, -ln(u) / q AS key FROM sized),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER o AS k, sum(2 * source_size) OVER o AS full_limit, sum(w) OVER o AS full_w, sum(w) OVER () AS all_w,
    sum(source_size) OVER () * 1.5::DOUBLE AS total FROM per WINDOW o AS (ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
rates AS (
  SELECT k - 1 AS limited, (total - (full_limit - 2 * source_size)) / CAST(all_w - full_w + w AS DOUBLE) AS rate, w, source_size FROM ranked),
pick AS (SELECT rate FROM rates WHERE rate * w <= 2 * source_size ORDER BY limited LIMIT 1),
goal AS (
  SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), (SELECT rate FROM pick) * w) AS target FROM per),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM goal),
run AS (
  SELECT doc_id, size, c.source_size, c.target, epochs, target - epochs * c.source_size AS budget,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM keyed k JOIN cut c ON k.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target, CAST(size * (epochs
  + CASE WHEN upto - size / 2.0 <= budget AND upto - size < budget THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM run
"""


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = quality.train(docs, table(spark, folder, "labels"))
    found = quality.score(docs.select("doc_id", "text", "n_chars"), model)
    return found.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = linededup.report(documents(spark, folder))
    return found.withColumn("text_sha256", F.sha2("kept", 256)).drop("kept")


# A line goes if it lies in a stretch of 50 words or more that stands earlier too.
OP8_SQL = r"""
WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, pos, line, trimmed, len(regexp_extract_all(trimmed, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS trimmed
    FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM raw))),
sums AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM lines),
ends AS (SELECT doc_id, upto, min(pos) AS pos FROM sums GROUP BY doc_id, upto),
begins AS (SELECT doc_id, upto - words AS before, max(pos) AS pos FROM sums GROUP BY doc_id, upto - words),
spans AS (
  SELECT s.doc_id, s.pos AS a, e.pos AS b FROM sums s ASOF JOIN ends e ON s.doc_id = e.doc_id AND s.upto - s.words + 50 <= e.upto
  UNION
  SELECT s.doc_id, f.pos AS a, s.pos AS b FROM sums s ASOF JOIN begins f ON s.doc_id = f.doc_id AND s.upto - 50 >= f.before),
whole AS (
  SELECT s.doc_id, a, b, string_agg(trimmed, chr(10) ORDER BY pos) AS body
  FROM spans s JOIN lines l ON l.doc_id = s.doc_id AND l.pos BETWEEN a AND b WHERE a <= b GROUP BY ALL),
firsts AS (SELECT *, first_value({'d': doc_id, 'b': b}) OVER (PARTITION BY body ORDER BY doc_id, a) AS f FROM whole),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS pos FROM firsts WHERE f.d < doc_id OR (f.d = doc_id AND a > f.b)),
marked AS (SELECT l.*, g.pos IS NOT NULL AS hit FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos),
edges AS (SELECT *, hit AND NOT coalesce(lag(hit) OVER o, false) AS opens FROM marked WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
runs AS (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM edges),
texts AS (
  SELECT doc_id, string_agg(a || ':' || b, ',' ORDER BY a) AS runs
  FROM (SELECT doc_id, run, min(pos) AS a, max(pos) + 1 AS b FROM runs WHERE hit GROUP BY doc_id, run) GROUP BY doc_id),
totals AS (
  SELECT doc_id, count(*) AS n_lines, sum(words) AS n_words, count(*) FILTER (hit) AS removed_lines, sum(words) FILTER (hit) AS removed_words,
    string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit) AS kept FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
  CAST(coalesce(removed_lines, 0) AS BIGINT) AS removed_lines, CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words,
  coalesce(texts.runs, '') AS runs, CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS text_sha256
FROM documents d LEFT JOIN totals ON d.doc_id = totals.doc_id LEFT JOIN texts ON d.doc_id = texts.doc_id
"""


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, folder))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {
    "op1_decontaminate": op1_decontaminate, "op2_mix_sources": op2_mix_sources, "op5_quality_classifier": op5_quality_classifier,
    "op8_line_dedup": op8_line_dedup, "op10_simhash": op10_simhash,
}
SQL = {"op1_decontaminate": OP1_SQL, "op2_mix_sources": OP2_SQL, "op8_line_dedup": OP8_SQL}
