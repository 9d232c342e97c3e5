"""Registered queries: time and count windows.

Processing-time windows run on the event's own time as the ingest time, since a
bounded table has no other; the plan is the same for `proctime()`.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.operators.counts import count_slide, count_tumble
from weirstone.operators.running import running_count, running_sum
from weirstone.operators.windows import (
    count_of,
    count_rows,
    dense_hop,
    early_results,
    max_of,
    session_windows,
    sum_of,
    window_aggregate,
)
from weirstone.plans.inputs import HOUR, MINUTE, SENSOR, floored, paned, sensor
from weirstone.plans.registry import query
from weirstone.sources.tables import as_view

def _sums():
    return {"vc_sum": F.sum("vc")}


def tumble_sql(keys: str, size: int, aggs: str) -> str:
    start = floored(size)
    return (
        f"WITH {SENSOR} SELECT {keys}, {start} AS window_start, {start} + INTERVAL {size // 1_000_000} SECOND"
        f" AS window_end, {aggs} FROM sensor GROUP BY {keys}, {start}"
    )


def hop_sql(keys: str, size: int, slide: int, aggs: str) -> str:
    return (
        f"WITH {SENSOR} SELECT {keys}, make_timestamp(ws) AS window_start, make_timestamp(ws + {size}) AS window_end,"
        f" {aggs} FROM {paned('sensor', size, slide)} GROUP BY {keys}, ws"
    )


def session_sql(keys: str, gap_minutes: int, aggs: str) -> str:
    gap = f"INTERVAL {gap_minutes} MINUTE"
    return (
        f"WITH {SENSOR}, o AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY {keys} ORDER BY ts) <= {gap}"
        f" THEN 0 ELSE 1 END AS opens FROM sensor),"
        f" g AS (SELECT *, sum(opens) OVER (PARTITION BY {keys} ORDER BY ts, seq) AS grp FROM o)"
        f" SELECT {keys}, min(ts) AS window_start, max(ts) + {gap} AS window_end, {aggs} FROM g GROUP BY {keys}, grp"
    )


_VC = "CAST(sum(vc) AS BIGINT) AS vc_sum"


def _tumble(name, keys, size, size_us):
    @query(name, tumble_sql(", ".join(keys), size_us, _VC))
    def build(spark, folder):
        return window_aggregate(sensor(spark, folder), keys=keys, ts="ts", size=size, aggs=_sums())


def _hop(name, keys, size, slide, size_us, slide_us):
    @query(name, hop_sql(", ".join(keys), size_us, slide_us, _VC))
    def build(spark, folder):
        return window_aggregate(sensor(spark, folder), keys=keys, ts="ts", size=size, slide=slide, aggs=_sums())


def _session(name, keys, minutes):
    @query(name, session_sql(", ".join(keys), minutes, "count(*) AS ct, " + _VC))
    def build(spark, folder):
        return session_windows(
            sensor(spark, folder), keys=keys, ts="ts", gap=f"{minutes} minutes",
            measures={"ct": count_rows(), "vc_sum": sum_of("vc")},
        )


_tumble("tumble_proc", ["user_id"], "1 day", 24 * HOUR)
_tumble("tumble_event", ["id"], "1 hour", HOUR)
_tumble("tbl_tumble_pt", ["id"], "5 seconds", 5_000_000)
_tumble("tbl_tumble_rt", ["user_id"], "5 minutes", 5 * MINUTE)
_hop("hop_proc", ["id"], "6 seconds", "2 seconds", 6_000_000, 2_000_000)
_hop("hop_event", ["id"], "6 hours", "2 hours", 6 * HOUR, 2 * HOUR)
_hop("tbl_hop_pt", ["user_id"], "6 hours", "2 hours", 6 * HOUR, 2 * HOUR)
_hop("tbl_hop_rt", ["id"], "3 hours", "2 hours", 3 * HOUR, 2 * HOUR)
_session("session_proc", ["user_id"], 120)
_session("session_event", ["id"], 45)
_session("tbl_session_pt", ["id"], 20)
_session("tbl_session_rt", ["user_id"], 600)


@query(
    "count_tumble",
    f"""WITH {SENSOR}, n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) - 1 AS n FROM sensor)
    SELECT id, n // 5 AS window_no, {_VC} FROM n GROUP BY id, n // 5 HAVING count(*) = 5""",
)
def count_tumble_rows(spark, folder):
    return count_tumble(sensor(spark, folder).select("id", "seq", "vc"), keys=["id"], order=["seq"], size=5, aggs=_sums())


def _slide_sql(keys: str, extra: str = "") -> str:
    return f"""WITH {SENSOR}, n AS (SELECT *, row_number() OVER w AS fired_at,
      CAST(sum(vc) OVER (PARTITION BY {keys} ORDER BY seq ROWS 4 PRECEDING) AS BIGINT) AS vc_sum
      FROM sensor WINDOW w AS (PARTITION BY {keys} ORDER BY seq))
    SELECT {keys}, fired_at, vc_sum FROM n WHERE fired_at % 2 = 0{extra}"""


@query("count_slide", _slide_sql("id"))
def count_slide_rows(spark, folder):
    return count_slide(
        sensor(spark, folder).select("id", "seq", "vc"), keys=["id"], order=["seq"], size=5, slide=2, aggs=_sums()
    )


@query(
    "tbl_count_tumble",
    f"""WITH {SENSOR}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq) - 1 AS n FROM sensor)
    SELECT user_id, n // 5 AS window_no, count(*) AS ct, max(vc) AS vc_max FROM n GROUP BY user_id, n // 5 HAVING count(*) = 5""",
)
def tbl_count_tumble(spark, folder):
    return count_tumble(
        sensor(spark, folder).select("user_id", "seq", "vc"), keys=["user_id"], order=["seq"], size=5,
        aggs={"ct": F.count(F.lit(1)), "vc_max": F.max("vc")},
    )


@query("tbl_count_slide", _slide_sql("user_id", " AND fired_at >= 5"))
def tbl_count_slide(spark, folder):
    return count_slide(
        sensor(spark, folder).select("user_id", "seq", "vc"), keys=["user_id"], order=["seq"], size=5, slide=2,
        aggs=_sums(), full_only=True,
    )


@query("agg_with_window_end", tumble_sql("id", HOUR, "count(*) AS ct, CAST(sum(vc) AS DOUBLE) / count(vc) AS mean"))
def agg_with_window_end(spark, folder):
    return window_aggregate(
        sensor(spark, folder), keys=["id"], ts="ts", size="1 hour",
        aggs={"ct": F.count(F.lit(1)), "mean": F.sum("vc").cast("double") / F.count("vc")},
    )


@query("window_process_uv", tumble_sql("id", 24 * HOUR, "count(DISTINCT user_id) AS uv, count(*) AS size"))
def window_process_uv(spark, folder):
    return window_aggregate(
        sensor(spark, folder), keys=["id"], ts="ts", size="1 day",
        aggs={"uv": F.count_distinct("user_id"), "size": F.count(F.lit(1))},
    )


@query("sql_tumble", f"WITH {SENSOR} SELECT id, {floored(HOUR)} AS window_start, count(id) AS ct FROM sensor GROUP BY id, {floored(HOUR)}")
def sql_tumble(spark, folder):
    as_view(sensor(spark, folder), "sensor_tumble")
    return spark.sql(
        "SELECT id, w.start AS window_start, ct FROM (SELECT id, window(ts, '1 hour') AS w, count(id) AS ct"
        " FROM sensor_tumble GROUP BY id, window(ts, '1 hour'))"
    )


@query("sql_hop", hop_sql("id", 6 * HOUR, 2 * HOUR, "count(id) AS ct"))
def sql_hop(spark, folder):
    as_view(sensor(spark, folder), "sensor_hop")
    return spark.sql(
        "SELECT id, w.start AS window_start, w.end AS window_end, ct FROM (SELECT id,"
        " window(ts, '6 hours', '2 hours') AS w, count(id) AS ct FROM sensor_hop"
        " GROUP BY id, window(ts, '6 hours', '2 hours'))"
    )


@query("sql_session", session_sql("user_id", 60, "count(id) AS ct"))
def sql_session(spark, folder):
    """Sessions by name in SQL. `session_window` brings a key's rows into one task; `session_windows` splits hot keys."""
    as_view(sensor(spark, folder), "sensor_rows")
    return spark.sql(
        "SELECT user_id, w.start AS window_start, w.end AS window_end, ct FROM"
        " (SELECT user_id, session_window(ts, '60 minutes') AS w, count(id) AS ct FROM sensor_rows GROUP BY user_id, session_window(ts, '60 minutes'))"
    )


@query("hop_dense", hop_sql("id", 12 * HOUR, MINUTE, "count(*) AS ct"))
def hop_dense(spark, folder):
    return dense_hop(
        sensor(spark, folder), keys=["id"], ts="ts", size="12 hours", slide="1 minute", measures={"ct": count_rows()}
    )


@query("hop_dense_double", hop_sql("id", 2 * HOUR, MINUTE, "round(sum(vc / 100.0::DOUBLE), 4) AS value_sum"))
def hop_dense_double(spark, folder):
    panes = dense_hop(
        sensor(spark, folder).withColumn("value", F.col("vc") / 100), keys=["id"], ts="ts", size="2 hours", slide="1 minute",
        measures={"value_sum": sum_of("value")},
    )
    return panes.withColumn("value_sum", F.round("value_sum", 4))


@query("hop_dense_max", hop_sql("id", 2 * HOUR, MINUTE, "max(vc) AS vc_max, count(*) AS ct"))
def hop_dense_max(spark, folder):
    return dense_hop(
        sensor(spark, folder), keys=["id"], ts="ts", size="2 hours", slide="1 minute",
        measures={"vc_max": max_of("vc"), "ct": count_rows()},
    )


@query(
    "window_early_fire",
    f"""WITH {SENSOR} SELECT seq, {floored(HOUR)} AS window_start,
    count(*) OVER w AS ct, CAST(sum(vc) OVER w AS BIGINT) AS vc_sum FROM sensor
    WINDOW w AS (PARTITION BY {floored(HOUR)} ORDER BY seq)""",
)
def window_early_fire(spark, folder):
    out = early_results(
        sensor(spark, folder), keys=[], ts="ts", size="1 hour", order=["seq"],
        folds={"ct": running_count(), "vc_sum": running_sum(F.col("vc"))},
    )
    return out.select("seq", "window_start", "ct", "vc_sum")
