"""Registered queries: OVER windows, ranking, running top-n."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.operators.over import over_rows, over_unbounded
from weirstone.operators.rolling import running_top
from weirstone.operators.running import chunked, running_count, running_sum
from weirstone.plans.hot_lists import hot_items
from weirstone.plans.inputs import HOUR, SENSOR, paned, sensor
from weirstone.plans.registry import query
from weirstone.sources.tables import as_view


@query("over_unbounded", f"WITH {SENSOR} SELECT seq, CAST(sum(vc) OVER (ORDER BY ts) AS BIGINT) AS total FROM sensor")
def over_unbounded_rows(spark, folder):
    rows = sensor(spark, folder).select("seq", "ts", "vc")
    return over_unbounded(rows, order=["ts"], folds={"total": running_sum(F.col("vc"))}).select("seq", "total")


@query(
    "over_rows_2",
    f"WITH {SENSOR} SELECT id, seq, CAST(sum(vc) OVER (PARTITION BY id ORDER BY seq ROWS 2 PRECEDING) AS BIGINT) AS total FROM sensor",
)
def over_rows_2(spark, folder):
    rows = sensor(spark, folder).select("id", "seq", "vc")
    return over_rows(rows, keys=["id"], order=["seq"], preceding=2, aggs={"total": F.sum("vc")}).drop("vc")


# Hour-level time, so that rows do share it.
_HOURLY = f"hourly AS (SELECT seq, id, date_trunc('hour', ts) AS rt FROM sensor)"


@query(
    "over_range_event",
    f"WITH {SENSOR}, {_HOURLY} SELECT id, seq, count(*) OVER (PARTITION BY id ORDER BY rt) AS ct FROM hourly",
)
def over_range_event(spark, folder):
    rows = sensor(spark, folder).select("id", "seq", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("rt"))
    return over_unbounded(rows, keys=["id"], order=["rt"], folds={"ct": running_count()}).select("id", "seq", "ct")


@query(
    "sql_over_named",
    f"""WITH {SENSOR} SELECT user_id, seq, count(vc) OVER w AS ct, CAST(sum(vc) OVER w AS BIGINT) AS vc_sum FROM sensor
    WINDOW w AS (PARTITION BY user_id ORDER BY seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def sql_over_named(spark, folder):
    """A named window over a view whose chunks split hot keys."""
    rows = sensor(spark, folder).select("user_id", "seq", "vc")
    as_view(
        chunked(rows, keys=["user_id"], order=["seq"], preceding=2, number="n", chunk=1 << 16), "sensor_over"
    )
    return spark.sql(
        "SELECT user_id, seq, ct, vc_sum FROM (SELECT *, count(vc) OVER w AS ct, sum(vc) OVER w AS vc_sum"
        " FROM sensor_over WINDOW w AS (PARTITION BY user_id, _at ORDER BY n ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"
        " WHERE _own"
    )


TOP_ITEMS_SQL = f"""WITH {SENSOR}, v AS (SELECT user_id AS item, ts FROM sensor WHERE id = 'view'),
    c AS (SELECT item, make_timestamp(ws + {6 * HOUR}) AS window_end, count(*) AS ct FROM {paned('v', 6 * HOUR, HOUR)} GROUP BY item, ws),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY ct DESC, item) AS INTEGER) AS rk FROM c)
    SELECT item, window_end, ct, rk FROM r WHERE rk <= 5"""


@query("sql_topn_items", TOP_ITEMS_SQL)
def sql_topn_items(spark, folder):
    as_view(sensor(spark, folder).where("id = 'view'").select(F.col("user_id").alias("item"), "ts"), "item_views")
    as_view(
        spark.sql(
            "SELECT item, w.end AS window_end, ct FROM (SELECT item, window(ts, '6 hours', '1 hour') AS w,"
            " count(*) AS ct FROM item_views GROUP BY item, window(ts, '6 hours', '1 hour'))"
        ),
        "item_counts",
    )
    return spark.sql(
        "SELECT item, window_end, ct, rk FROM (SELECT *, row_number() OVER"
        " (PARTITION BY window_end ORDER BY ct DESC, item) AS rk FROM item_counts) WHERE rk <= 5"
    )


@query("topn_items", TOP_ITEMS_SQL)
def topn_items(spark, folder):
    views = sensor(spark, folder).where("id = 'view'").select(F.col("user_id").alias("item"), "ts")
    return hot_items(views, item="item", ts="ts", size="6 hours", slide="1 hour", n=5)


@query(
    "running_top3",
    f"""WITH {SENSOR} SELECT user_id, seq, array_to_string(list_transform(list_sort(list(vc) OVER
    (PARTITION BY user_id ORDER BY seq), 'DESC')[1:3], lambda x: CAST(x AS VARCHAR)), ',') AS top FROM sensor""",
)
def running_top3(spark, folder):
    rows = sensor(spark, folder).select("user_id", "seq", "vc")
    out = running_top(rows, keys=["user_id"], order=["seq"], value="vc", n=3)
    return out.select("user_id", "seq", F.concat_ws(",", F.col("top").cast("array<string>")).alias("top"))
