"""Registered queries: union, connect, joins, broadcast state."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.operators import joins as J
from weirstone.plans.inputs import HOUR, PAYS, SENSOR, pays, receipts, sensor
from weirstone.plans.registry import query
from weirstone.sources.files import table
from weirstone.sources.tables import as_view


@query(
    "union_all",
    f"WITH {SENSOR} SELECT seq, id FROM sensor WHERE id = 'view' UNION ALL SELECT seq, id FROM sensor WHERE id <> 'click'",
)
def union_all(spark, folder):
    rows = sensor(spark, folder).select("seq", "id")
    return J.union_all(rows.where("id = 'view'"), rows.where("id <> 'click'"))


@query(
    "connect_comap",
    "SELECT 'left' AS _side, c_name AS str, CAST(length(c_name) AS INTEGER) AS num FROM customer"
    " UNION ALL SELECT 'right', p_brand, p_size FROM part",
)
def connect_comap(spark, folder):
    return J.connect(
        table(spark, folder, "customer"),
        table(spark, folder, "part"),
        [F.col("c_name").alias("str"), F.length("c_name").alias("num")],
        [F.col("p_brand").alias("str"), F.col("p_size").alias("num")],
    )


@query(
    "reconcile_inner",
    "SELECT o_orderkey AS tx, o_totalprice, l_linenumber, l_shipdate FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
)
def reconcile_inner(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("tx"), "o_totalprice")
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("tx"), "l_linenumber", "l_shipdate")
    return J.match_keys(orders, lines, ["tx"])


_MATCHED = (
    f"matched AS (SELECT p.tx, pay_id, pay_ts, receipt_id, receipt_ts FROM pays p JOIN receipts r ON p.tx = r.tx"
    f" AND epoch_us(receipt_ts) - epoch_us(pay_ts) BETWEEN {-2 * HOUR} AND {4 * HOUR})"
)


def _reconciled(spark, folder):
    events = table(spark, folder, "events")
    return J.reconcile(
        pays(events), receipts(events), keys=["tx"], left_id="pay_id", right_id="receipt_id",
        left_ts="pay_ts", right_ts="receipt_ts", lower="-2 hours", upper="4 hours",
    )


@query("reconcile_matched", f"WITH {PAYS}, {_MATCHED} SELECT tx, pay_id, pay_ts, receipt_id, receipt_ts FROM matched")
def reconcile_matched(spark, folder):
    return _reconciled(spark, folder)[0]


@query(
    "pay_no_receipt",
    f"WITH {PAYS}, {_MATCHED} SELECT tx, pay_id, pay_ts FROM pays WHERE pay_id NOT IN (SELECT pay_id FROM matched)",
)
def pay_no_receipt(spark, folder):
    return _reconciled(spark, folder)[1]


@query(
    "receipt_no_pay",
    f"WITH {PAYS}, {_MATCHED} SELECT tx, receipt_id, receipt_ts FROM receipts WHERE receipt_id NOT IN (SELECT receipt_id FROM matched)",
)
def receipt_no_pay(spark, folder):
    return _reconciled(spark, folder)[2]


@query(
    "interval_join",
    "SELECT o_orderkey AS tx, o_orderdate, l_linenumber, l_shipdate FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
    " AND l_shipdate BETWEEN o_orderdate - INTERVAL 5 DAY AND o_orderdate + INTERVAL 10 DAY",
)
def interval_join(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("tx"), "o_orderdate")
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("tx"), "l_linenumber", "l_shipdate")
    return J.interval_join(
        orders, lines, keys=["tx"], left_ts="o_orderdate", right_ts="l_shipdate", lower="-5 days", upper="10 days"
    )


@query(
    "sql_left_join",
    "SELECT c.c_custkey, c.c_name, o.o_orderkey FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey",
)
def sql_left_join(spark, folder):
    as_view(table(spark, folder, "customer"), "table_a")
    as_view(table(spark, folder, "orders"), "table_b")
    # The matches of an inner join can be split where a key is hot; of an outer join only the left side can.
    return spark.sql(
        "SELECT a.c_custkey, a.c_name, b.o_orderkey FROM table_a a JOIN table_b b ON a.c_custkey = b.o_custkey"
        " UNION ALL SELECT a.c_custkey, a.c_name, CAST(NULL AS BIGINT) FROM table_a a LEFT ANTI JOIN table_b b ON a.c_custkey = b.o_custkey"
    )


KEEP = 12 * HOUR
LEFT_JOIN_SQL = f"""WITH {PAYS}, pairs AS (SELECT p.tx, pay_id, receipt_id FROM pays p JOIN receipts r ON p.tx = r.tx
      AND abs(epoch_us(receipt_ts) - epoch_us(pay_ts)) <= {KEEP}),
    firsts AS (SELECT pay_id, min(receipt_id) AS first FROM pairs GROUP BY pay_id)
    SELECT tx, greatest(pay_id, receipt_id) AS step, true AS added, pay_id, receipt_id FROM pairs
    UNION ALL SELECT tx, pay_id, true, pay_id, NULL FROM pays LEFT JOIN firsts USING (pay_id) WHERE first IS NULL OR first > pay_id
    UNION ALL SELECT tx, first, false, pay_id, NULL FROM pays JOIN firsts USING (pay_id) WHERE first > pay_id"""
LEFT_JOIN = {"keys": ["tx"], "left_id": "pay_id", "right_id": "receipt_id", "left_ts": "pay_ts", "right_ts": "receipt_ts", "keep": "12 hours"}


@query("left_join_changelog", LEFT_JOIN_SQL)
def left_join_changelog(spark, folder):
    events = table(spark, folder, "events")
    return J.left_join_changelog(pays(events), receipts(events), **LEFT_JOIN)


SWITCH_SQL = f"""WITH {SENSOR}, both_rows AS (
      SELECT seq, id, true AS is_data, NULL AS ctl FROM sensor WHERE id <> 'signup'
      UNION ALL SELECT seq, NULL, false, CAST(user_id % 3 AS VARCHAR) FROM sensor WHERE id = 'signup'),
    seen AS (SELECT *, last_value(ctl IGNORE NULLS) OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING) AS sw FROM both_rows)
    SELECT seq, id, CASE sw WHEN '1' THEN 'switch 1' WHEN '2' THEN 'switch 2' ELSE 'other' END AS outcome
    FROM seen WHERE is_data"""


def outcome(switch: str):
    """The branch a data row takes by the control value."""
    return F.when(F.col(switch) == "1", "switch 1").when(F.col(switch) == "2", "switch 2").otherwise("other")


@query("broadcast_switch", SWITCH_SQL)
def broadcast_switch(spark, folder):
    rows = sensor(spark, folder)
    control = rows.where("id = 'signup'").select("seq", (F.col("user_id") % 3).cast("string").alias("ctl"))
    data = rows.where("id <> 'signup'").select("seq", "id")
    out = J.control_switch(data, control, seq="seq", value="ctl")
    return out.select("seq", "id", outcome("switch").alias("outcome"))
