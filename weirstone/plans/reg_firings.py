"""Registered queries: every firing of windows that late rows fire again, and lists ranked anew."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.operators.firings import hot_versions, late_firings
from weirstone.operators.running import running_count, running_max, running_sum
from weirstone.plans.inputs import HOUR, JITTER, MINUTE, jittered, jittered_id, paned
from weirstone.plans.registry import query
from weirstone.session import scratch
from weirstone.streaming.feed import Feed
from weirstone.streaming.late import LateFirings
from weirstone.streaming.runner import drain

_SIZES = {"size": "1 hour", "delay": "2 hours", "lateness": "2 hours"}


def _folds():
    return {"ct": running_count(), "vc_sum": running_sum(F.col("vc")), "vc_max": running_max(F.col("vc"))}


FIRINGS_SQL = f"""WITH {JITTER}, seen AS (SELECT *, max(epoch_us(ts)) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      - {2 * HOUR} AS wm, epoch_us(ts) - epoch_us(ts) % {HOUR} + {HOUR} AS we FROM jitter),
    accepted AS (SELECT *, CAST(wm IS NOT NULL AND we <= wm AS INT) AS late FROM seen WHERE wm IS NULL OR we + {2 * HOUR} > wm),
    r AS (SELECT id, we, seq, late, count(*) OVER w AS ct, CAST(sum(vc) OVER w AS BIGINT) AS vc_sum, max(vc) OVER w AS vc_max,
      CAST(sum(late) OVER w + max(1 - late) OVER w AS BIGINT) AS firing, lead(late) OVER o AS next_late
      FROM accepted WINDOW o AS (PARTITION BY id, we ORDER BY seq), w AS (PARTITION BY id, we ORDER BY seq ROWS UNBOUNDED PRECEDING))
    SELECT id, make_timestamp(we - {HOUR}) AS window_start, make_timestamp(we) AS window_end, firing, ct, vc_sum, vc_max
    FROM r WHERE late = 1 OR coalesce(next_late, 1) = 1"""


@query("late_firings", FIRINGS_SQL)
def late_firings_rows(spark, folder):
    return late_firings(jittered(spark, folder), keys=["id"], ts="ts", order=["seq"], folds=_folds(), **_SIZES)


@query("stream_late_firings", FIRINGS_SQL)
def stream_late_firings(spark, folder):
    """The same firings from a stream whose rows arrive out of order, slice by slice."""
    feed = Feed(spark, folder, "events", "_arrival", shape=lambda df: df.withColumn("_arrival", jittered_id()))
    rows = feed.stream.select(
        F.col("_arrival").alias("seq"), F.col("event_type").alias("id"), F.col("ts").cast("timestamp").alias("ts"), F.round(F.col("value") * 100).cast("long").alias("vc")
    )
    target = scratch(spark, "firings")

    def write(out, batch_id):
        out.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    firings = LateFirings(spark, rows, keys=["id"], ts="ts", order=["seq"], folds=_folds(), write=write, **_SIZES)
    drain(rows, firings, mode="append", feed=feed)
    firings.flush(spark)
    return spark.read.schema(
        "id string, window_start timestamp_ntz, window_end timestamp_ntz, firing long, ct long, vc_sum long, vc_max long"
    ).parquet(f"{target}/batch_id=*")


@query(
    "hot_urls_versions",
    f"""WITH {JITTER}, hits AS (SELECT seq, ts, '/p/' || CAST(user_id % 37 AS VARCHAR) AS url FROM jitter),
    seen AS (SELECT *, max(epoch_us(ts)) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {2 * HOUR} AS wm FROM hits),
    pairs AS (SELECT url, seq, ws, wm IS NOT NULL AND ws <= wm - {6 * HOUR} AS late FROM {paned('seen', 6 * HOUR, 30 * MINUTE)}
      WHERE wm IS NULL OR ws > wm - {10 * HOUR}),
    base AS (SELECT ws, url, count(*) AS ct FROM pairs WHERE NOT late GROUP BY ws, url),
    opened AS (SELECT DISTINCT ws, 1 AS b FROM base),
    ups AS (SELECT ws, url, row_number() OVER (PARTITION BY ws ORDER BY seq) + coalesce(b, 0) AS version,
      row_number() OVER (PARTITION BY ws, url ORDER BY seq) AS own FROM pairs LEFT JOIN opened USING (ws) WHERE late),
    grid AS (SELECT u.ws, u.version, n.url FROM ups u JOIN (SELECT DISTINCT ws, url FROM pairs) n ON u.ws = n.ws),
    grown AS (SELECT g.ws, g.version, g.url, coalesce(b.ct, 0) + coalesce(s.own, 0) AS ct
      FROM grid g ASOF LEFT JOIN ups s ON g.ws = s.ws AND g.url = s.url AND g.version >= s.version
      LEFT JOIN base b ON b.ws = g.ws AND b.url = g.url),
    every AS (SELECT ws, 1 AS version, url, ct FROM base UNION ALL SELECT ws, version, url, ct FROM grown WHERE ct > 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY ws, version ORDER BY ct DESC, url) AS INTEGER) AS rk FROM every)
    SELECT url, make_timestamp(ws + {6 * HOUR}) AS window_end, CAST(version AS BIGINT) AS version, CAST(ct AS BIGINT) AS ct, rk FROM r WHERE rk <= 3""",
)
def hot_urls_versions(spark, folder):
    hits = jittered(spark, folder).select("seq", "ts", F.concat(F.lit("/p/"), F.pmod("user_id", F.lit(37)).cast("string")).alias("url"))
    return hot_versions(
        hits, item="url", ts="ts", order=["seq"], size="6 hours", slide="30 minutes", delay="2 hours", lateness="4 hours", n=3
    )
