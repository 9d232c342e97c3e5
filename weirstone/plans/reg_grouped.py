"""Registered queries: grouped and rolling aggregates, changelog, distinct."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.operators.rolling import (
    changelog_count,
    first_per_key,
    rolling_average,
    rolling_max,
    rolling_max_by,
    rolling_reduce,
    rolling_sum,
    running_distinct,
)
from weirstone.operators.running import first_value, last_known, numbered, running_max
from weirstone.plans.inputs import SENSOR, WORDS, bare_words, sensor, word_rows
from weirstone.plans.registry import query
from weirstone.sources.files import table
from weirstone.sources.tables import as_view
from weirstone.streaming.feed import Feed
from weirstone.streaming.runner import latest_rows

_W = "WINDOW w AS (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING)"
WORDCOUNT_SQL = f"WITH {WORDS} SELECT word, count(*) AS ct FROM words GROUP BY word"


@query("wordcount_batch", WORDCOUNT_SQL)
def wordcount_batch(spark, folder):
    return bare_words(spark, folder).groupBy("word").agg(F.count(F.lit(1)).alias("ct"))


@query(
    "wordcount_running",
    f"WITH {WORDS} SELECT doc_id, pos, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, pos) AS ct FROM words",
)
def wordcount_running(spark, folder):
    return numbered(word_rows(spark, folder), keys=["word"], order=["doc_id", "pos"], name="ct")


@query("wordcount_stream", WORDCOUNT_SQL)
def wordcount_stream(spark, folder):
    feed = Feed(spark, folder, "documents", "doc_id")
    words = feed.stream.select(F.explode(F.split("text", "[ \n]")).alias("word"))
    counts = words.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("ct"))
    return latest_rows(counts, keys=["word"], feed=feed)


def _plain(spark, folder):
    return sensor(spark, folder).select("id", "seq", "ts", "vc")


@query(
    "rolling_max",
    f"WITH {SENSOR} SELECT id, seq, first_value(ts) OVER w AS first_ts, max(vc) OVER w AS max_vc FROM sensor {_W}",
)
def rolling_max_rows(spark, folder):
    out = rolling_max(_plain(spark, folder), keys=["id"], order=["seq"], value="vc", keep=["ts"])
    return out.select("id", "seq", "first_ts", "max_vc")


@query(
    "rolling_maxby",
    f"WITH {SENSOR}, m AS (SELECT id, seq, max({{'v': vc, 's': seq}}) OVER w AS b FROM sensor {_W})"
    " SELECT m.id, m.seq, m.b.v AS best_vc, s.ts AS best_ts FROM m JOIN sensor s ON s.seq = m.b.s",
)
def rolling_maxby(spark, folder):
    out = rolling_max_by(_plain(spark, folder), keys=["id"], order=["seq"], value="vc", keep=["ts"])
    return out.select("id", "seq", "best_vc", "best_ts")


@query(
    "reduce_latest_max",
    f"WITH {SENSOR} SELECT id, seq, first_value(seq) OVER w AS first_seq, ts AS latest_ts, max(vc) OVER w AS max_vc FROM sensor {_W}",
)
def reduce_latest_max(spark, folder):
    out = rolling_reduce(
        _plain(spark, folder),
        keys=["id"],
        order=["seq"],
        folds={
            "first_seq": first_value(F.col("seq")),
            "latest_ts": last_known(F.col("ts")),
            "max_vc": running_max(F.col("vc")),
        },
    )
    return out.select("id", "seq", "first_seq", "latest_ts", "max_vc")


@query(
    "running_count_by_key",
    f"WITH {SENSOR} SELECT id, seq, row_number() OVER (PARTITION BY id ORDER BY seq) AS ct FROM sensor",
)
def running_count_by_key(spark, folder):
    return numbered(sensor(spark, folder).select("id", "seq"), keys=["id"], order=["seq"], name="ct")


@query("table_group_count", f"WITH {SENSOR} SELECT id, count(id) AS ct FROM sensor GROUP BY id")
def table_group_count(spark, folder):
    return sensor(spark, folder).groupBy("id").agg(F.count("id").alias("ct"))


@query(
    "sql_group_agg",
    f"WITH {SENSOR} SELECT user_id, count(ts) AS ct, CAST(sum(vc) AS BIGINT) AS vc_sum FROM sensor GROUP BY user_id",
)
def sql_group_agg(spark, folder):
    as_view(sensor(spark, folder), "sensor_sql")
    return spark.sql("SELECT user_id, count(ts) AS ct, sum(vc) AS vc_sum FROM sensor_sql GROUP BY user_id")


CHANGELOG_SQL = f"""WITH {SENSOR}, r AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY seq) AS step FROM sensor)
    SELECT id, step, true AS added, step AS ct FROM r
    UNION ALL SELECT id, step, false, step - 1 FROM r WHERE step > 1"""


@query("changelog_count", CHANGELOG_SQL)
def changelog(spark, folder):
    return changelog_count(sensor(spark, folder).select("id", "seq"), keys=["id"], order=["seq"])


@query("distinct_words", f"WITH {WORDS} SELECT DISTINCT word FROM words")
def distinct_words(spark, folder):
    return bare_words(spark, folder).dropDuplicates(["word"])


@query(
    "distinct_id_vc",
    f"WITH {SENSOR} SELECT id, vc, min(seq) AS seq FROM sensor GROUP BY id, vc",
)
def distinct_id_vc(spark, folder):
    return first_per_key(sensor(spark, folder).select("id", "vc", "seq"), keys=["id", "vc"], order=["seq"])


@query(
    "uv_running",
    "WITH f AS (SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id)"
    " SELECT user_id, event_id, row_number() OVER (ORDER BY event_id) AS uv FROM f",
)
def uv_running(spark, folder):
    return running_distinct(table(spark, folder, "events"), value="user_id", order=["event_id"])


@query("uv_total", "SELECT count(DISTINCT user_id) AS uv FROM events")
def uv_total(spark, folder):
    return table(spark, folder, "events").agg(F.count_distinct("user_id").alias("uv"))


@query(
    "running_sum",
    f"WITH {SENSOR} SELECT user_id, seq, CAST(sum(vc) OVER (PARTITION BY user_id ORDER BY seq) AS BIGINT) AS total FROM sensor",
)
def running_sum_rows(spark, folder):
    return rolling_sum(sensor(spark, folder).select("user_id", "seq", "vc"), keys=["user_id"], order=["seq"], value="vc").drop("vc")


@query(
    "running_avg",
    f"WITH {SENSOR} SELECT id, seq, CAST(sum(vc) OVER w AS DOUBLE) / count(*) OVER w AS mean FROM sensor {_W}",
)
def running_avg_rows(spark, folder):
    return rolling_average(_plain(spark, folder), keys=["id"], order=["seq"], value="vc").select("id", "seq", "mean")


@query("running_count_all", "SELECT event_id, row_number() OVER (ORDER BY event_id) AS ct FROM events")
def running_count_all(spark, folder):
    return numbered(table(spark, folder, "events").select("event_id"), keys=[], order=["event_id"], name="ct")
