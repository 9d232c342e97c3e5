"""Queries of the operators that encode texts and vectors or weigh texts against a target."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from weirstone.llm import codes, importance, pieces
from weirstone.llm.common import documents
from weirstone.sources.files import table

PIECES = "piece_bpe_32k.model"


def op11_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = pieces.read_model(public_tokenizers.path(PIECES))
    ids = pieces.encode(documents(spark, folder).select("doc_id", "text"), model).select("doc_id", "ids")
    found = pieces.decode(ids, model)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    found, books = codes.compressed(table(spark, folder, "embeddings"))
    return found.select(
        "vec_id", codes.hex_code(F.col("code")).alias("code"), "error", "label_error", F.sha2(F.lit(books.listed()), 256).alias("codebooks_sha256")
    )


def _step_sql(k: int, vectors: str = "parts") -> str:
    """One round: the nearest entries of codebook k, and codebook k + 1."""
    return f"""near{k} AS MATERIALIZED (
  SELECT vec_id, label, row, p, v, arg_min(e, d * 1000 + e) AS e, min(d) AS d FROM (
    SELECT x.vec_id, x.label, x.row, x.p, x.v, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM {vectors} x JOIN book{k} b ON x.p = b.p) GROUP BY ALL),
book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(n.v, b.v) AS v FROM book{k} b LEFT JOIN (
    SELECT p, e, list(m ORDER BY j) AS v FROM (
      SELECT p, e, j, CAST(floor(sum(v[j]) / count(*)) AS BIGINT) AS m FROM near{k}, range(1, 5) r(j) GROUP BY p, e, j) GROUP BY p, e) n
  ON b.p = n.p AND b.e = n.e)"""


OP12_SQL = f"""
WITH sound AS (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) AS row FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, row, p, list_transform(embedding[p * 4 + 1:p * 4 + 4], lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
  FROM sound, range(16) r(p)),
book0 AS (SELECT p, row - 1 AS e, v FROM parts WHERE row <= 64),
{_step_sql(0)},
{_step_sql(1)},
{_step_sql(2)},
listed AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2),
coded AS (
  SELECT vec_id, label, row, string_agg(lower(lpad(hex(e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near2 GROUP BY vec_id, label, row)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, listed
"""


def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.weighed(documents(spark, folder), table(spark, folder, "benchmark"), keep=["doc_id"])


QUERIES = {"op11_sentencepiece": op11_sentencepiece, "op12_vector_codes": op12_vector_codes, "op13_importance": op13_importance}
SQL = {"op12_vector_codes": OP12_SQL}
