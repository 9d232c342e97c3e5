"""Registered queries: projections, filters, splits and repartitioning."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.operators import rows as R
from weirstone.plans.inputs import SENSOR, WORDS, sensor, word_rows
from weirstone.plans.registry import query
from weirstone.sources.files import table


@query(
    "map_project",
    f"WITH {SENSOR} SELECT seq, vc * vc AS squared, CAST(length(id) AS INTEGER) AS len FROM sensor",
)
def map_project(spark, folder):
    return R.project(
        sensor(spark, folder), seq=F.col("seq"), squared=F.col("vc") * F.col("vc"), len=F.length("id")
    )


def _open():
    return {"prefix": "row-"}


def _tag(resource, batch):
    return batch.assign(tag=resource["prefix"] + batch["seq"].astype(str))[["seq", "tag"]]


@query("map_partitions_lifecycle", f"WITH {SENSOR} SELECT seq, 'row-' || CAST(seq AS VARCHAR) AS tag FROM sensor")
def map_partitions_lifecycle(spark, folder):
    return R.map_with_lifecycle(
        sensor(spark, folder).select("seq"), _open, _tag, lambda resource: resource.clear(), "seq long, tag string"
    )


@query("flatmap_words", f"WITH {WORDS} SELECT doc_id, word FROM words")
def flatmap_words(spark, folder):
    return R.words(table(spark, folder, "documents"), "text", sep="[ \n]", keep=["doc_id"])


@query(
    "flatmap_powers",
    "SELECT p_partkey, unnest([p_size * p_size, p_size * p_size * p_size]) AS power FROM part",
)
def flatmap_powers(spark, folder):
    x = F.col("p_size")
    return R.flat_map(table(spark, folder, "part"), F.array(x * x, x * x * x), "power", keep=["p_partkey"])


_CSV_LINE = "p_name || ',' || p_brand || ',' || p_type"


@query("flatmap_csv", f"SELECT p_partkey, unnest(string_split({_CSV_LINE}, ',')) AS field FROM part")
def flatmap_csv(spark, folder):
    lines = table(spark, folder, "part").select("p_partkey", F.concat_ws(",", "p_name", "p_brand", "p_type").alias("line"))
    return R.flat_map(lines, F.split("line", ","), "field", keep=["p_partkey"])


@query("filter_pred", f"WITH {SENSOR} SELECT seq, id, vc FROM sensor WHERE vc > 3000 AND seq % 2 = 0")
def filter_pred(spark, folder):
    return sensor(spark, folder).where("vc > 3000 AND seq % 2 = 0").select("seq", "id", "vc")


@query("filter_parse", "SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'")
def filter_parse(spark, folder):
    return table(spark, folder, "events").where("event_type = 'view'").select("event_id", "user_id", "ts")


@query("table_where_select", f"WITH {SENSOR} SELECT id, ts, vc FROM sensor WHERE id = 'click' AND vc >= 2000")
def table_where_select(spark, folder):
    return sensor(spark, folder).where((F.col("id") == "click") & (F.col("vc") >= 2000)).selectExpr("id", "ts", "vc")


@query("process_words", f"WITH {WORDS} SELECT word, CAST(length(word) AS INTEGER) AS len, CAST(1 AS INTEGER) AS one FROM words")
def process_words(spark, folder):
    return R.project(word_rows(spark, folder), word=F.col("word"), len=F.length("word"), one=F.lit(1))


def _tagged(spark, folder):
    return R.tag_split(sensor(spark, folder), F.col("vc") >= 3000)


@query("split_main", f"WITH {SENSOR} SELECT seq, id, user_id, ts, vc FROM sensor WHERE vc >= 3000")
def split_main(spark, folder):
    return R.branch(_tagged(spark, folder), "main")


@query("split_side", f"WITH {SENSOR} SELECT id, vc FROM sensor WHERE NOT (vc >= 3000)")
def split_side(spark, folder):
    return R.branch(_tagged(spark, folder), "side", "id", "vc")


@query(
    "keyby_parity",
    f"WITH {SENSOR} SELECT CASE WHEN vc % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, count(*) AS ct, CAST(sum(vc) AS BIGINT) AS vc_sum FROM sensor GROUP BY 1",
)
def keyby_parity(spark, folder):
    parity = F.when(F.col("vc") % 2 == 0, "even").otherwise("odd")
    return R.key_groups(sensor(spark, folder), parity, "parity", ct=F.count(F.lit(1)), vc_sum=F.sum("vc"))


_ROWS = f"WITH {SENSOR} SELECT seq, id, vc FROM sensor"


@query("repartition_roundrobin", _ROWS)
def repartition_roundrobin(spark, folder):
    return R.rebalance(sensor(spark, folder).select("seq", "id", "vc"))


@query("coalesce_n", _ROWS)
def coalesce_n(spark, folder):
    rows = sensor(spark, folder).select("seq", "id", "vc")
    return R.rescale(rows, max(1, spark.sparkContext.defaultParallelism // 2))


@query("global_one", f"WITH {SENSOR} SELECT id, count(*) AS ct FROM sensor GROUP BY id")
def global_one(spark, folder):
    """Everything in one task is only done to a result that is already aggregated."""
    return R.to_single_task(sensor(spark, folder).groupBy("id").agg(F.count(F.lit(1)).alias("ct")))


@query("replicate_rows", f"WITH {SENSOR} SELECT seq, CAST(unnest(range(4)) AS INTEGER) AS copy FROM sensor")
def replicate_rows(spark, folder):
    return R.replicate(sensor(spark, folder).select("seq"), 4)
