"""Registered queries: the analytics jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.plans import ads, page_views
from weirstone.plans.hot_lists import hot_urls, parse_access_line
from weirstone.plans.inputs import HOUR, JITTER, MINUTE, SENSOR, access_lines, floored, jittered, paned, sensor, sensor_stream
from weirstone.plans.registry import query
from weirstone.session import scratch
from weirstone.streaming.runner import drain

_HOUR_END = f"{floored(HOUR)} + INTERVAL 1 HOUR"
_VIEWS = f"{SENSOR}, views AS (SELECT * FROM sensor WHERE id = 'view')"


def _views(spark, folder):
    return sensor(spark, folder).where("id = 'view'")


@query("pv_total", f"WITH {_VIEWS} SELECT 'pv' AS name, count(*) AS pv FROM views")
def pv_total(spark, folder):
    return _views(spark, folder).agg(F.count(F.lit(1)).alias("pv")).select(F.lit("pv").alias("name"), "pv")


_PV_SQL = f"WITH {_VIEWS} SELECT {_HOUR_END} AS window_end, count(*) AS pv FROM views GROUP BY 1"


@query("pv_hourly", _PV_SQL)
def pv_hourly(spark, folder):
    return page_views.pv_hourly(_views(spark, folder))


@query("pv_hourly_salted", _PV_SQL)
def pv_hourly_salted(spark, folder):
    return page_views.pv_hourly_salted(_views(spark, folder))


@query("uv_hourly", f"WITH {_VIEWS} SELECT {_HOUR_END} AS window_end, count(DISTINCT user_id) AS uv FROM views GROUP BY 1")
def uv_hourly(spark, folder):
    return page_views.uv_hourly(_views(spark, folder), "user_id")


_HASHED = f"""{_VIEWS}, hashed AS (SELECT ts, list_reduce(list_prepend(CAST(0 AS BIGINT),
      list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda a, c: (a * 32 + c) & 1073741823) AS bit FROM views)"""
_UV_BITS = f"WITH {_HASHED} SELECT {_HOUR_END} AS window_end, count(DISTINCT bit) AS uv FROM hashed GROUP BY 1"


@query("uv_hourly_bitmap", _UV_BITS)
def uv_hourly_bitmap(spark, folder):
    return page_views.uv_hourly_bitmap(_views(spark, folder), "user_id")


@query("stream_uv_hourly_bitmap", _UV_BITS)
def stream_uv_hourly_bitmap(spark, folder):
    """Each micro-batch leaves its bitmaps, which are united on reading."""
    rows, feed = sensor_stream(spark, folder)
    log = page_views.VisitorLog(scratch(spark, "visitors"), "user_id")
    drain(rows.where("id = 'view'"), log.write, mode="append", feed=feed)
    return page_views.counted_bitmaps(log.read(spark))


@query(
    "uv_daily_from_hours",
    f"WITH {_HASHED} SELECT date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, count(DISTINCT bit) AS uv FROM hashed GROUP BY 1",
)
def uv_daily_from_hours(spark, folder):
    """Days from the stored bitmaps of their hours; the visitors are not read again."""
    path = scratch(spark, "visitors")
    page_views.hourly_bitmaps(_views(spark, folder), "user_id").write.parquet(path)
    stored = spark.read.schema("hour timestamp_ntz, piece long, bits binary").parquet(path)
    return page_views.counted_bitmaps(page_views.united_bitmaps(stored, "day"), "1 day")


@query(
    "uv_hourly_hll",
    f"WITH {_VIEWS} SELECT {_HOUR_END} AS window_end, count(DISTINCT user_id) AS uv, count(DISTINCT user_id) AS exact FROM views GROUP BY 1",
)
def uv_hourly_hll(spark, folder):
    """The sketch's own value as `uv`, and the exact count beside it.

    Below some hundred users an hour the sketch still holds each of them and has no error;
    the tests hold it to its bound beyond that.
    """
    views = _views(spark, folder)
    told = page_views.counted_sketches(page_views.hourly_sketches(views, "user_id"))
    return page_views.uv_hourly(views, "user_id").withColumnRenamed("uv", "exact").join(told, "window_end").select("window_end", "uv", "exact")


@query(
    "parse_access_log",
    """SELECT event_id AS seq, '10.0.0.' || CAST(user_id % 256 AS VARCHAR) AS ip, CAST(user_id AS VARCHAR) AS "user",
    date_trunc('second', ts) AS ts, 'GET' AS method, '/p/' || CAST(user_id % 37 AS VARCHAR) AS url
    FROM events WHERE event_type <> 'error'""",
)
def parse_access_log(spark, folder):
    parsed = access_lines(spark, folder).select("seq", *parse_access_line(F.col("line")))
    return parsed.where("method = 'GET'")


_CLOSED = f"wm - {4 * HOUR} - {6 * HOUR}"


@query(
    "hot_urls",
    f"""WITH {JITTER}, hits AS (SELECT seq, ts, '/p/' || CAST(user_id % 37 AS VARCHAR) AS url FROM jitter),
    seen AS (SELECT *, max(epoch_us(ts)) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {2 * HOUR} AS wm FROM hits),
    c AS (SELECT url, ws, count(*) AS ct FROM {paned('seen', 6 * HOUR, 10 * MINUTE)}
      WHERE wm IS NULL OR ws > {_CLOSED} GROUP BY url, ws),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY ws ORDER BY ct DESC, url) AS INTEGER) AS rk FROM c)
    SELECT url, make_timestamp(ws + {6 * HOUR}) AS window_end, ct, rk FROM r WHERE rk <= 5""",
)
def hot_urls_rows(spark, folder):
    hits = jittered(spark, folder).select(
        "seq", "ts", F.concat(F.lit("/p/"), F.pmod("user_id", F.lit(37)).cast("string")).alias("url")
    )
    return hot_urls(
        hits, url="url", ts="ts", order=["seq"], size="6 hours", slide="10 minutes", delay="2 hours",
        lateness="4 hours", n=5,
    )


@query(
    "market_by_channel",
    f"WITH {SENSOR} SELECT user_id % 4 AS channel, id AS behavior, count(*) AS ct FROM sensor GROUP BY 1, 2",
)
def market_by_channel(spark, folder):
    rows = sensor(spark, folder).select((F.col("user_id") % 4).alias("channel"), F.col("id").alias("behavior"))
    return rows.groupBy("channel", "behavior").agg(F.count(F.lit(1)).alias("ct"))


_CLICKS = f"""{SENSOR}, judged AS (SELECT seq, user_id, id, ts, user_id % 7 AS province, row_number() OVER
    (PARTITION BY user_id, id, CAST(ts + INTERVAL 8 HOUR AS DATE) ORDER BY seq) AS n FROM sensor)"""


def _judged(spark, folder):
    clicks = sensor(spark, folder).withColumn("province", F.col("user_id") % 7)
    return ads.judge_clicks(clicks, user="user_id", ad="id", ts="ts", order=["seq"], limit=2)


@query("ad_blacklist", f"WITH {_CLICKS} SELECT seq, user_id, id AS ad, ts FROM judged WHERE n = 2")
def ad_blacklist(spark, folder):
    return _judged(spark, folder).where("verdict = 'alert'").select("seq", "user_id", F.col("id").alias("ad"), "ts")


@query(
    "ad_clicks_province",
    f"""WITH {_CLICKS}, passed AS (SELECT province, ts FROM judged WHERE n < 2)
    SELECT province, make_timestamp(ws) AS window_start, make_timestamp(ws + {HOUR}) AS window_end, count(*) AS ct
    FROM {paned('passed', HOUR, MINUTE)} GROUP BY province, ws""",
)
def ad_clicks_province(spark, folder):
    passed = _judged(spark, folder).where("verdict = 'pass'")
    return ads.clicks_by_province(passed, province="province", ts="ts", slide="1 minute")


@query("sensor_counts", f"WITH {SENSOR} SELECT id, count(*) AS ct FROM sensor GROUP BY id")
def sensor_counts(spark, folder):
    return sensor(spark, folder).groupBy("id").agg(F.count(F.lit(1)).alias("ct"))
