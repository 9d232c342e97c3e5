"""Registered queries: Structured Streaming forms, compared with the same SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.functions.timecols import epoch_micros
from weirstone.operators.joins import control_switch, interval_join
from weirstone.plans.inputs import HOUR, PAYS, SENSOR, pays, receipts, sensor_stream
from weirstone.plans.reg_grouped import CHANGELOG_SQL
from weirstone.plans.reg_joins import LEFT_JOIN, LEFT_JOIN_SQL, SWITCH_SQL, outcome
from weirstone.plans.reg_windows import hop_sql
from weirstone.plans.registry import query
from weirstone.operators.rolling import changelog_count
from weirstone.operators.windows import window_aggregate
from weirstone.session import scratch
from weirstone.streaming.processors import (
    CountWindow,
    DailyLimit,
    FirstSeen,
    JumpAlert,
    stateful,
)
from weirstone.streaming.feed import Feed
from weirstone.streaming.joins import LeftJoinLog
from weirstone.streaming.runner import appended_rows, drain, latest_rows
from weirstone.streaming.state import Versions

_NTZ = "timestamp_ntz"


def _arrivals(spark, folder, *columns):
    rows, feed = sensor_stream(spark, folder)
    return rows.withColumn("_seq", F.col("seq")).select("_seq", *columns), feed


@query("stream_hop", hop_sql("id", 6 * HOUR, 2 * HOUR, "count(*) AS ct"))
def stream_hop(spark, folder):
    rows, feed = sensor_stream(spark, folder)
    rows = rows.withWatermark("ts", "2 seconds")
    counts = window_aggregate(
        rows, keys=["id"], ts="ts", size="6 hours", slide="2 hours", aggs={"ct": F.count(F.lit(1))}
    )
    final = latest_rows(counts, keys=["id", "window_start", "window_end"], feed=feed)
    return final.select(
        "id", F.col("window_start").cast(_NTZ).alias("window_start"), F.col("window_end").cast(_NTZ).alias("window_end"), "ct"
    )


@query(
    "stream_interval_join",
    f"WITH {PAYS} SELECT p.tx, pay_id, receipt_id FROM pays p JOIN receipts r ON p.tx = r.tx"
    f" AND epoch_us(receipt_ts) - epoch_us(pay_ts) BETWEEN {-2 * HOUR} AND {4 * HOUR}",
)
def stream_interval_join(spark, folder):
    feed = Feed(spark, folder, "events", "event_id")
    events = feed.stream.withColumn("ts", F.col("ts").cast("timestamp"))
    joined = interval_join(
        pays(events).withWatermark("pay_ts", "10 seconds"),
        receipts(events).withWatermark("receipt_ts", "10 seconds"),
        keys=["tx"], left_ts="pay_ts", right_ts="receipt_ts", lower="-2 hours", upper="4 hours",
    )
    return appended_rows(joined.select("tx", "pay_id", "receipt_id"), feed=feed)


@query("stream_left_join", LEFT_JOIN_SQL)
def stream_left_join(spark, folder):
    """The changelog of the left join, each micro-batch against the rows that are still kept."""
    feed = Feed(spark, folder, "events", "event_id")
    events = feed.stream.withColumn("ts", F.col("ts").cast("timestamp"))
    target = scratch(spark, "rows")

    def write(out, batch_id):
        out.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    job = LeftJoinLog(spark, lambda rows: (pays(rows), receipts(rows)), events, delay="10 seconds", write=write, **LEFT_JOIN)
    drain(events, job, mode="append", feed=feed)
    return spark.read.schema("tx long, step long, added boolean, pay_id long, receipt_id long").parquet(f"{target}/batch_id=*")


@query("stream_distinct", f"WITH {SENSOR} SELECT DISTINCT id, vc FROM sensor")
def stream_distinct(spark, folder):
    rows, feed = sensor_stream(spark, folder)
    return appended_rows(rows.select("id", "vc").dropDuplicates(["id", "vc"]), feed=feed)


@query("stream_changelog", CHANGELOG_SQL)
def stream_changelog(spark, folder):
    """The bounded form on each micro-batch, on top of the counts of those before."""
    rows, feed = sensor_stream(spark, folder)
    target, state = scratch(spark, "rows"), Versions(spark, "id string, n long")

    def step(batch, batch_id):
        counted = state.before(spark, batch_id)
        out = changelog_count(batch.select("id", "seq"), keys=["id"], order=["seq"], counted=counted)
        out.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        fresh = batch.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        state.write(counted.union(fresh).groupBy("id").agg(F.sum("n").alias("n")), batch_id)

    drain(rows, step, mode="append", feed=feed)
    return spark.read.schema("id string, step long, added boolean, ct long").parquet(f"{target}/batch_id=*")


@query(
    "stream_count_slide",
    f"""WITH {SENSOR}, n AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS fired_at,
      CAST(sum(vc) OVER (PARTITION BY user_id ORDER BY seq ROWS 4 PRECEDING) AS BIGINT) AS vc_sum FROM sensor)
    SELECT user_id, fired_at, vc_sum FROM n WHERE fired_at % 2 = 0""",
)
def stream_count_slide(spark, folder):
    out = "user_id long, fired_at long, vc_sum long"
    rows, feed = _arrivals(spark, folder, "user_id", "vc")
    fired = stateful(rows, keys=["user_id"], processor=CountWindow(out, "vc", 5, 2), output=out)
    return appended_rows(fired, mode="update", feed=feed)


@query(
    "stream_vc_jump",
    f"""WITH {SENSOR}, p AS (SELECT user_id, seq, vc, lag(vc) OVER (PARTITION BY user_id ORDER BY seq) AS prev_vc FROM sensor)
    SELECT user_id, seq, prev_vc, vc FROM p WHERE abs(vc - prev_vc) > 5000""",
)
def stream_vc_jump(spark, folder):
    out = "user_id long, seq long, prev_vc long, vc long"
    rows, feed = _arrivals(spark, folder, "user_id", "vc")
    jumps = stateful(rows, keys=["user_id"], processor=JumpAlert(out, "vc", 5000), output=out)
    return appended_rows(jumps, mode="update", feed=feed)


@query(
    "stream_first_seen",
    f"WITH {SENSOR} SELECT user_id, min(seq) AS seq, vc // 100 AS v FROM sensor GROUP BY user_id, vc // 100",
)
def stream_first_seen(spark, folder):
    out = "user_id long, seq long, v long"
    rows, feed = _arrivals(spark, folder, "user_id", F.expr("vc div 100").alias("v"))
    return appended_rows(
        stateful(rows, keys=["user_id"], processor=FirstSeen(out, "v"), output=out), mode="update", feed=feed
    )


@query("stream_switch", SWITCH_SQL)
def stream_switch(spark, folder):
    """The as-of form on each micro-batch, which begins with the last control value of those before."""
    rows, feed = sensor_stream(spark, folder)
    target, state = scratch(spark, "rows"), Versions(spark, "seq long, ctl string")

    def step(batch, batch_id):
        fresh = batch.where("id = 'signup'").select("seq", (F.col("user_id") % 3).cast("string").alias("ctl"))
        control = fresh.union(state.before(spark, batch_id))
        out = control_switch(batch.where("id <> 'signup'").select("seq", "id"), control, seq="seq", value="ctl", name="ctl")
        out.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        state.write(control.orderBy(F.desc("seq")).limit(1), batch_id)

    drain(rows, step, mode="append", feed=feed)
    switched = spark.read.schema("seq long, id string, ctl string").parquet(f"{target}/batch_id=*")
    return switched.select("seq", "id", outcome("ctl").alias("outcome"))


@query(
    "stream_daily_limit",
    f"""WITH {SENSOR}, n AS (SELECT user_id, seq, row_number() OVER (PARTITION BY user_id,
      CAST(ts + INTERVAL 8 HOUR AS DATE) ORDER BY seq) AS n FROM sensor)
    SELECT user_id, seq, CASE WHEN n < 3 THEN 'pass' ELSE 'alert' END AS tag FROM n WHERE n <= 3""",
)
def stream_daily_limit(spark, folder):
    out = "user_id long, seq long, tag string"
    rows, feed = sensor_stream(spark, folder)
    rows = (
        rows.withWatermark("ts", "2 seconds")
        .select("user_id", F.col("seq").alias("_seq"), epoch_micros("ts").alias("_us"), "ts")
    )
    judged = stateful(
        rows, keys=["user_id"], processor=DailyLimit(out, limit=3, offset_hours=8), output=out, time_mode="EventTime"
    )
    return appended_rows(judged, mode="update", feed=feed)
