"""Registered queries: patterns, timers and sessions on a stream, compared with the SQL of their bounded forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weirstone.functions.timecols import epoch_micros, from_micros
from weirstone.operators.windows import streaming_session
from weirstone.plans.inputs import HOUR, SENSOR, shape_sensor
from weirstone.plans.registry import SQL, query
from weirstone.streaming.feed import Feed
from weirstone.streaming.processors import EventOrdered, FollowedBy, NoDropAlert, PayMonitor, RangeCount, Reconcile, StrictRepeat, stateful
from weirstone.streaming.runner import appended_rows

# User of the row that ends the input.
END = -1
_NTZ = "timestamp_ntz"


def _rows(spark: SparkSession, folder: str, kinds: list[str] | None = None) -> tuple[DataFrame, Feed]:
    """Watermarked sensor rows of some kinds, up to a row that lets all timers fire."""
    feed = Feed(spark, folder, "events", "event_id", end="ts", marks={"user_id": END, "event_id": END})
    rows = shape_sensor(feed.stream).withColumn("ts", F.col("ts").cast("timestamp"))
    if kinds is not None:
        rows = rows.where(F.col("id").isin(kinds) | (F.col("user_id") == END))
    return rows.withWatermark("ts", "2 seconds"), feed


def _watched(spark: SparkSession, folder: str, processor: EventOrdered, out: str, columns: list[Column], kinds: list[str] | None = None) -> DataFrame:
    rows, feed = _rows(spark, folder, kinds)
    shaped = rows.select("user_id", "ts", F.col("seq").alias("_seq"), epoch_micros("ts").alias("_us"), *columns)
    found = stateful(shaped, keys=["user_id"], processor=processor, output=out, time_mode="EventTime")
    return appended_rows(found, mode="update", feed=feed).where(F.col("user_id") != END)


def _times(df: DataFrame, **names: str) -> DataFrame:
    """user_id, and the named times made of microseconds."""
    return df.select("user_id", *[from_micros(F.col(us)).alias(name) for name, us in names.items()])


def _is(kind: str) -> Column:
    return F.coalesce(F.col("id") == kind, F.lit(False))


@query("stream_login_fail", SQL["cep_login_fail"])
def stream_login_fail(spark, folder):
    out = "user_id long, first_us long, last_us long"
    found = _watched(spark, folder, StrictRepeat(out, 2, 12 * HOUR), out, [_is("error").alias("hit")], ["error", "signup"])
    return _times(found, first_ts="first_us", last_ts="last_us")


def _followed(spark, folder, tag):
    out = "user_id long, start_us long, end_us long, tag string"
    columns = [_is("click").alias("starts"), _is("purchase").alias("ends")]
    return _watched(spark, folder, FollowedBy(out, 12 * HOUR), out, columns, ["click", "purchase"]).where(F.col("tag") == tag)


@query("stream_order_paid", SQL["cep_order_paid"])
def stream_order_paid(spark, folder):
    return _times(_followed(spark, folder, "matched"), start_ts="start_us", end_ts="end_us")


@query("stream_order_timeout", SQL["cep_order_timeout"])
def stream_order_timeout(spark, folder):
    return _times(_followed(spark, folder, "timeout"), start_ts="start_us", timeout_ts="end_us")


@query("stream_order_no_pay", SQL["order_no_pay"])
def stream_order_no_pay(spark, folder):
    out = "user_id long, create_us long, other_us long, tag string"
    found = _watched(spark, folder, PayMonitor(out, 12 * HOUR), out, [_is("click").alias("creates")], ["click", "purchase"])
    return _times(found.where("tag = 'no_pay'"), create_ts="create_us", timeout_ts="other_us")


@query("stream_no_drop", SQL["no_drop_alert"])
def stream_no_drop(spark, folder):
    out = "user_id long, start_us long, alert_us long"
    found = _watched(spark, folder, NoDropAlert(out, "vc", 12 * HOUR, rearm=False), out, [F.col("vc")])
    return _times(found, run_start="start_us", alert_at="alert_us")


@query("stream_no_drop_rearm", SQL["no_drop_rearm"])
def stream_no_drop_rearm(spark, folder):
    out = "user_id long, start_us long, alert_us long"
    found = _watched(spark, folder, NoDropAlert(out, "vc", 6 * HOUR), out, [F.col("vc")])
    return _times(found, run_start="start_us", alert_at="alert_us")


@query(
    "stream_reconcile",
    f"""WITH {SENSOR}, p AS (SELECT user_id, ts FROM sensor WHERE id = 'purchase'), r AS (SELECT user_id, ts FROM sensor WHERE id = 'signup')
    SELECT p.user_id, p.ts AS pay_ts, r.ts AS receipt_ts FROM p JOIN r ON p.user_id = r.user_id
    AND epoch_us(r.ts) - epoch_us(p.ts) BETWEEN {-2 * HOUR} AND {4 * HOUR}""",
)
def stream_reconcile(spark, folder):
    out = "user_id long, left_us long, right_us long, tag string"
    side = F.when(_is("purchase"), "left").otherwise("right").alias("side")
    found = _watched(spark, folder, Reconcile(out, -2 * HOUR, 4 * HOUR), out, [side], ["purchase", "signup"])
    return _times(found.where("tag = 'matched'"), pay_ts="left_us", receipt_ts="right_us")


@query(
    "stream_over_range",
    f"WITH {SENSOR} SELECT user_id, seq, count(*) OVER (PARTITION BY user_id ORDER BY ts) AS ct FROM sensor",
)
def stream_over_range(spark, folder):
    out = "user_id long, seq long, ct long"
    return _watched(spark, folder, RangeCount(out), out, [F.lit(0).cast("long").alias("payload")])


@query("stream_session", SQL["tbl_session_rt"])
def stream_session(spark, folder):
    rows, feed = _rows(spark, folder)
    aggs = {"ct": F.count(F.lit(1)), "vc_sum": F.sum("vc")}
    found = appended_rows(streaming_session(rows, keys=["user_id"], ts="ts", gap="600 minutes", aggs=aggs), feed=feed)
    return found.where(F.col("user_id") != END).select("user_id", *[F.col(c).cast(_NTZ).alias(c) for c in ("window_start", "window_end")], *aggs)
