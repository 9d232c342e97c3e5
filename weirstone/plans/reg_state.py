"""Registered queries: watermarks, late data, state alerts and event patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.functions.timecols import ddl_rowtime, event_time
from weirstone.operators.late import classify_lateness, split_late, watermark_trace
from weirstone.operators.patterns import (
    fail_pairs,
    fails_in_window,
    followed_by,
    no_drop_alerts,
    pay_monitor,
    strict_repeat,
)
from weirstone.operators.running import previous, running
from weirstone.operators.windows import window_aggregate
from weirstone.plans.inputs import HOUR, JITTER, SENSOR, floored, jittered, sensor, sensor_stream
from weirstone.plans.registry import query
from weirstone.plans.reg_windows import tumble_sql
from weirstone.sources.files import table
from weirstone.streaming.runner import latest_rows

_NTZ = "timestamp_ntz"


@query("watermark_bounded", tumble_sql("id", HOUR, "CAST(sum(vc) AS BIGINT) AS vc_sum"))
def watermark_bounded(spark, folder):
    """Event-time windows of a watermarked stream; update mode keeps the open ones."""
    rows, feed = sensor_stream(spark, folder)
    rows = rows.withWatermark("ts", "2 seconds")
    sums = window_aggregate(rows, keys=["id"], ts="ts", size="1 hour", aggs={"vc_sum": F.sum("vc")})
    final = latest_rows(sums, keys=["id", "window_start", "window_end"], feed=feed)
    return final.select(
        "id", F.col("window_start").cast(_NTZ).alias("window_start"), F.col("window_end").cast(_NTZ).alias("window_end"),
        "vc_sum",
    )


@query(
    "epoch_to_ts",
    "SELECT event_id, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS from_seconds,"
    " make_timestamp((epoch_us(ts) // 1000) * 1000) AS from_millis FROM events",
)
def epoch_to_ts(spark, folder):
    at = F.col("ts").cast("timestamp")
    return table(spark, folder, "events").select(
        "event_id",
        event_time(F.unix_seconds(at)).cast(_NTZ).alias("from_seconds"),
        event_time(F.unix_millis(at), "millis").cast(_NTZ).alias("from_millis"),
    )


@query(
    "ddl_rowtime",
    "SELECT event_id, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS rt FROM events",
)
def ddl_rowtime_rows(spark, folder):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, folder, "events").select("event_id", ddl_rowtime(seconds).cast(_NTZ).alias("rt"))


@query(
    "watermark_trace",
    f"WITH {JITTER} SELECT seq, max(ts) OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING) - INTERVAL 2 SECOND AS watermark FROM jitter",
)
def watermark_trace_rows(spark, folder):
    rows = jittered(spark, folder).select("seq", "ts")
    return watermark_trace(rows, ts="ts", order=["seq"], delay="2 seconds").select("seq", "watermark")


_LATE = f"""{JITTER}, seen AS (SELECT *, max(epoch_us(ts)) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      - {2 * HOUR} AS wm, epoch_us(ts) - epoch_us(ts) % {HOUR} + {HOUR} AS we FROM jitter),
    judged AS (SELECT *, wm IS NOT NULL AND we + {2 * HOUR} <= wm AS too_late FROM seen)"""


def _judged(spark, folder):
    return classify_lateness(
        jittered(spark, folder), ts="ts", order=["seq"], size="1 hour", delay="2 hours", lateness="2 hours"
    )


@query(
    "late_main",
    f"""WITH {_LATE} SELECT id, make_timestamp(we - {HOUR}) AS window_start, make_timestamp(we) AS window_end,
    count(*) AS ct, CAST(sum(vc) AS BIGINT) AS vc_sum FROM judged WHERE NOT too_late GROUP BY id, we""",
)
def late_main(spark, folder):
    accepted, _ = split_late(_judged(spark, folder))
    return window_aggregate(
        accepted, keys=["id"], ts="ts", size="1 hour", aggs={"ct": F.count(F.lit(1)), "vc_sum": F.sum("vc")}
    )


@query("late_side", f"WITH {_LATE} SELECT seq, id, ts, vc FROM judged WHERE too_late")
def late_side(spark, folder):
    _, side = split_late(_judged(spark, folder))
    return side.select("seq", "id", "ts", "vc")


@query(
    "vc_jump",
    f"""WITH {SENSOR}, p AS (SELECT id, seq, vc, lag(vc) OVER (PARTITION BY id ORDER BY seq) AS prev_vc FROM sensor)
    SELECT id, seq, prev_vc, vc FROM p WHERE abs(vc - prev_vc) > 5000""",
)
def vc_jump(spark, folder):
    rows = running(
        sensor(spark, folder).select("id", "seq", "vc"), keys=["id"], order=["seq"],
        folds={"prev_vc": previous(F.col("vc"))},
    )
    return rows.where(F.abs(F.col("vc") - F.col("prev_vc")) > 5000)


@query(
    "no_drop_alert",
    f"""WITH {SENSOR}, p AS (SELECT *, coalesce(vc < lag(vc) OVER w, false) AS d FROM sensor WINDOW w AS (PARTITION BY user_id ORDER BY ts, seq)),
    s AS (SELECT *, sum(CASE WHEN d THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, seq) AS seg FROM p),
    g AS (SELECT user_id, seg, min(CASE WHEN NOT d THEN ts END) AS run_start, min(ts) AS seg_from FROM s GROUP BY user_id, seg),
    n AS (SELECT *, lead(seg_from) OVER (PARTITION BY user_id ORDER BY seg) AS seg_until FROM g)
    SELECT user_id, run_start, run_start + INTERVAL 12 HOUR AS alert_at FROM n
    WHERE run_start IS NOT NULL AND (seg_until IS NULL OR seg_until > run_start + INTERVAL 12 HOUR)""",
)
def no_drop_alert(spark, folder):
    return no_drop_alerts(
        sensor(spark, folder), keys=["user_id"], order=["ts", "seq"], value="vc", hold="12 hours"
    )


@query(
    "no_drop_rearm",
    f"""WITH RECURSIVE {SENSOR}, p AS (SELECT *, coalesce(vc < lag(vc) OVER w, false) AS d FROM sensor WINDOW w AS (PARTITION BY user_id ORDER BY ts, seq)),
    s AS (SELECT *, sum(CASE WHEN d THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, seq) AS seg FROM p),
    n AS (SELECT user_id, seg, lead(min(ts)) OVER (PARTITION BY user_id ORDER BY seg) AS seg_until FROM s GROUP BY user_id, seg),
    g AS (SELECT s.user_id, s.seg, s.ts FROM s JOIN n ON s.user_id = n.user_id AND s.seg = n.seg
      WHERE NOT d AND (seg_until IS NULL OR seg_until > ts + INTERVAL 6 HOUR)),
    chain AS (SELECT user_id, seg, min(ts) AS armed FROM g GROUP BY user_id, seg
      UNION ALL SELECT c.user_id, c.seg, min(g.ts) FROM chain c JOIN g ON c.user_id = g.user_id AND c.seg = g.seg AND g.ts > c.armed + INTERVAL 6 HOUR
      GROUP BY c.user_id, c.seg, c.armed)
    SELECT user_id, armed AS run_start, armed + INTERVAL 6 HOUR AS alert_at FROM chain""",
)
def no_drop_rearm(spark, folder):
    return no_drop_alerts(sensor(spark, folder), keys=["user_id"], order=["ts", "seq"], value="vc", hold="6 hours", rearm=True)


def _fails():
    return F.col("id") == "error"


_LOGIN = f"{SENSOR}, login AS (SELECT seq, user_id, ts, id = 'error' AS fail FROM sensor WHERE id IN ('error', 'signup'))"


def _logins(spark, folder):
    return sensor(spark, folder).where(F.col("id").isin("error", "signup"))


@query(
    "cep_login_fail",
    f"""WITH {_LOGIN}, p AS (SELECT user_id, ts AS last_ts, fail, lag(fail) OVER w AS pf, lag(ts) OVER w AS first_ts
      FROM login WINDOW w AS (PARTITION BY user_id ORDER BY ts, seq))
    SELECT user_id, first_ts, last_ts FROM p WHERE fail AND pf AND epoch_us(last_ts) - epoch_us(first_ts) < {12 * HOUR}""",
)
def cep_login_fail(spark, folder):
    return strict_repeat(
        _logins(spark, folder), keys=["user_id"], order=["ts", "seq"], matches=_fails(), times=2, within="12 hours"
    )


@query(
    "cep_login_fail_3",
    f"""WITH {_LOGIN}, p AS (SELECT user_id, ts AS last_ts, fail, lag(fail) OVER w AS pf, lag(fail, 2) OVER w AS ppf,
      lag(ts, 2) OVER w AS first_ts FROM login WINDOW w AS (PARTITION BY user_id ORDER BY ts, seq))
    SELECT user_id, first_ts, last_ts FROM p WHERE fail AND pf AND ppf AND epoch_us(last_ts) - epoch_us(first_ts) < {48 * HOUR}""",
)
def cep_login_fail_3(spark, folder):
    return strict_repeat(
        _logins(spark, folder), keys=["user_id"], order=["ts", "seq"], matches=_fails(), times=3, within="2 days"
    )


def _is(kind):
    return F.col("id") == kind


_FOLLOW = f"""{SENSOR}, o AS (SELECT user_id, seq, ts, id FROM sensor WHERE id IN ('click', 'purchase')),
    f AS (SELECT *, first_value(CASE WHEN id = 'purchase' THEN ts END IGNORE NULLS) OVER
      (PARTITION BY user_id ORDER BY ts, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS end_ts FROM o)"""
_IN_TIME = f"end_ts IS NOT NULL AND epoch_us(end_ts) - epoch_us(ts) < {12 * HOUR}"


def _orders(spark, folder):
    return followed_by(
        sensor(spark, folder), keys=["user_id"], order=["ts", "seq"], starts=_is("click"), ends=_is("purchase"), within="12 hours"
    )


@query(
    "cep_order_paid",
    f"WITH {_FOLLOW} SELECT user_id, ts AS start_ts, end_ts FROM f WHERE id = 'click' AND {_IN_TIME}",
)
def cep_order_paid(spark, folder):
    return _orders(spark, folder)[0]


@query(
    "cep_order_timeout",
    f"WITH {_FOLLOW} SELECT user_id, ts AS start_ts, ts + INTERVAL 12 HOUR AS timeout_ts FROM f WHERE id = 'click' AND NOT ({_IN_TIME})",
)
def cep_order_timeout(spark, folder):
    return _orders(spark, folder)[1]


_MONITOR = f"""{SENSOR}, o AS (SELECT user_id, seq, ts, id FROM sensor WHERE id IN ('click', 'purchase')),
    m AS (SELECT *, lag(id) OVER w AS pid, lag(ts) OVER w AS pts, lead(ts) OVER w AS nts FROM o
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, seq)),
    q AS (SELECT *, coalesce(pid = 'click' AND epoch_us(ts) - epoch_us(pts) <= {12 * HOUR}, false) AS ok FROM m)"""


def _monitored(spark, folder):
    return pay_monitor(
        sensor(spark, folder), keys=["user_id"], order=["ts", "seq"], creates=_is("click"), pays=_is("purchase"), within="12 hours"
    )


@query("order_paid", f"WITH {_MONITOR} SELECT user_id, pts AS create_ts, ts AS pay_ts FROM q WHERE id = 'purchase' AND ok")
def order_paid(spark, folder):
    return _monitored(spark, folder)[0]


@query("order_no_create", f"WITH {_MONITOR} SELECT user_id, ts AS pay_ts FROM q WHERE id = 'purchase' AND NOT ok")
def order_no_create(spark, folder):
    return _monitored(spark, folder)[1]


@query(
    "order_no_pay",
    f"""WITH {_MONITOR} SELECT user_id, ts AS create_ts, ts + INTERVAL 12 HOUR AS timeout_ts FROM q
    WHERE id = 'click' AND (nts IS NULL OR epoch_us(nts) - epoch_us(ts) > {12 * HOUR})""",
)
def order_no_pay(spark, folder):
    return _monitored(spark, folder)[2]


@query(
    "login_fail_window",
    f"""WITH {_LOGIN}, g AS (SELECT *, sum(CASE WHEN fail THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, seq) AS grp FROM login),
    s AS (SELECT *, min(ts) OVER (PARTITION BY user_id, grp) AS first_ts FROM g WHERE fail)
    SELECT user_id, first_ts, max(ts) AS last_ts, count(*) AS fails FROM s
    WHERE epoch_us(ts) - epoch_us(first_ts) <= {24 * HOUR} GROUP BY user_id, grp, first_ts HAVING count(*) >= 2""",
)
def login_fail_window(spark, folder):
    return fails_in_window(
        _logins(spark, folder), keys=["user_id"], order=["ts", "seq"], fails=_fails(), within="24 hours", at_least=2
    )


@query(
    "login_fail_pair",
    f"""WITH {JITTER}, login AS (SELECT seq, user_id, ts, id = 'error' AS fail FROM jitter WHERE id IN ('error', 'signup')),
    p AS (SELECT *, lag(fail) OVER w AS pf, lag(ts) OVER w AS pts FROM login WINDOW w AS (PARTITION BY user_id ORDER BY seq))
    SELECT user_id, seq, pts AS first_ts, ts AS last_ts FROM p WHERE fail AND pf AND abs(epoch_us(ts) - epoch_us(pts)) <= {24 * HOUR}""",
)
def login_fail_pair(spark, folder):
    rows = jittered(spark, folder).where(F.col("id").isin("error", "signup"))
    return fail_pairs(rows, keys=["user_id"], ts="ts", order=["seq"], fails=_fails(), within="24 hours")
