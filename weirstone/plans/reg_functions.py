"""Registered queries: scalar functions and user functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from weirstone.functions.udfs import aggregate_groups, aggregate_windows, register_length, register_split, running_aggregate, split_rows, top_values
from weirstone.operators.rolling import top_changelog
from weirstone.plans.inputs import HOUR, SENSOR, sensor
from weirstone.plans.reg_windows import hop_sql, tumble_sql
from weirstone.plans.registry import query
from weirstone.sources.codecs import encode_json
from weirstone.sources.files import table
from weirstone.sources.tables import as_view


@query(
    "fn_string",
    "SELECT p_partkey, string_split(p_name, ' ')[1] AS head, CAST(length(p_name) AS INTEGER) AS len,"
    " p_brand || '_' || p_type AS joined, p_type = 'SMALL' AS is_small FROM part",
)
def fn_string(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey",
        F.split("p_name", " ")[0].alias("head"),
        F.length("p_name").alias("len"),
        F.concat_ws("_", "p_brand", "p_type").alias("joined"),
        (F.col("p_type") == "SMALL").alias("is_small"),
    )


@query(
    "fn_math",
    f"""WITH {SENSOR} SELECT seq, abs(vc - 3000) AS dist, greatest(vc, 3000) AS top, vc % 7 AS rem, vc * vc AS sq,
    vc * vc * vc AS cube, vc & 1023 AS low_bits, vc // 86400 AS whole, CAST(vc AS DOUBLE) / 3 AS third FROM sensor""",
)
def fn_math(spark, folder):
    vc = F.col("vc")
    return sensor(spark, folder).select(
        "seq",
        F.abs(vc - 3000).alias("dist"),
        F.greatest(vc, F.lit(3000).cast("long")).alias("top"),
        (vc % 7).alias("rem"),
        (vc * vc).alias("sq"),
        (vc * vc * vc).alias("cube"),
        vc.bitwiseAND(F.lit(1023).cast("long")).alias("low_bits"),
        F.expr("vc div 86400").alias("whole"),
        (vc.cast("double") / 3).alias("third"),
    )


@query(
    "fn_time",
    "SELECT event_id, date_trunc('second', ts) AS parsed, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown,"
    " date_trunc('second', ts) - INTERVAL 5 SECOND AS five_before FROM events",
)
def fn_time(spark, folder):
    shown = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    parsed = F.to_timestamp_ntz(shown, F.lit("yyyy-MM-dd HH:mm:ss"))
    return table(spark, folder, "events").select(
        "event_id", parsed.alias("parsed"), shown.alias("shown"),
        (parsed - F.expr("INTERVAL '5' SECOND")).alias("five_before"),
    )


@query(
    "fn_json",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
    '{"event_type":"' || event_type || '","user_id":' || CAST(user_id AS VARCHAR) || '}' AS doc FROM events""",
)
def fn_json(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        F.from_json("props", "k long")["k"].alias("k"),
        encode_json(["event_type", "user_id"]).alias("doc"),
    )


@query("udf_len", "SELECT p_partkey, CAST(length(p_name) AS INTEGER) AS len FROM part")
def udf_len(spark, folder):
    register_length(spark, "mylen")
    as_view(table(spark, folder, "part"), "part_len")
    return spark.sql("SELECT p_partkey, mylen(p_name) AS len FROM part_len")


_SPLIT_SQL = "SELECT p_partkey, unnest(string_split(p_brand || '_' || p_type, '_')) AS word FROM part"


def _parts(spark, folder):
    return table(spark, folder, "part").select("p_partkey", F.concat_ws("_", "p_brand", "p_type").alias("code"))


@query("udtf_split", _SPLIT_SQL)
def udtf_split(spark, folder):
    register_split(spark, "split_words")
    as_view(_parts(spark, folder), "part_codes")
    return spark.sql("SELECT p_partkey, word FROM part_codes, LATERAL split_words(code)")


@query("udtf_split_native", _SPLIT_SQL)
def udtf_split_native(spark, folder):
    return split_rows(_parts(spark, folder), "code").select("p_partkey", "word")


_AVG_SQL = f"WITH {SENSOR} SELECT id, CAST(sum(vc) AS DOUBLE) / count(vc) AS mean FROM sensor GROUP BY id"


def _accumulate(rows):
    return int(rows["vc"].sum()), len(rows)


def _merge(a, b):
    return a[0] + b[0], a[1] + b[1]


@query("udaf_avg", _AVG_SQL)
def udaf_avg(spark, folder):
    return aggregate_groups(
        sensor(spark, folder), keys=["id"], columns=["vc"], state="vc_sum long, ct long",
        accumulate=_accumulate, merge=_merge, result=F.col("vc_sum").cast("double") / F.col("ct"), name="mean",
    )


@query(
    "udtaf_top2",
    f"""WITH {SENSOR}, r AS (SELECT id, vc, row_number() OVER (PARTITION BY id ORDER BY vc DESC, seq) AS n FROM sensor)
    SELECT id, vc AS value, 'Top' || CAST(n AS VARCHAR) AS rank FROM r WHERE n <= 2""",
)
def udtaf_top2(spark, folder):
    return top_values(sensor(spark, folder), keys=["id"], value="vc", n=2, ties=["seq"])


# A product modulo a prime: no built-in aggregate is one, and partial products merge.
PRIME = 1_000_003
_PRODUCT = f"lambda a, x: (a * ((x % {PRIME}) + 1)) % {PRIME}"


def _product_sql(values: str) -> str:
    return f"list_reduce({values}, {_PRODUCT}, CAST(1 AS BIGINT))"


def _lift(vc):
    return (1 if vc is None or vc != vc else (int(vc) % PRIME + 1) % PRIME,)


def _multiply(rows):
    return (reduce(lambda a, b: a * b % PRIME, (_lift(v)[0] for v in rows["vc"].tolist()), 1),)


def _times(a, b):
    return (int(a[0]) * int(b[0]) % PRIME,)


_USER = {"columns": ["vc"], "state": "product long", "accumulate": _multiply, "merge": _times, "name": "product"}


def _user_aggregate():
    return {**_USER, "result": F.col("product")}


_LISTED = "list(vc) FILTER (vc IS NOT NULL)"


@query("udaf_tumble", tumble_sql("id", HOUR, f"{_product_sql(_LISTED)} AS product"))
def udaf_tumble(spark, folder):
    return aggregate_windows(sensor(spark, folder), keys=["id"], ts="ts", size="1 hour", **_user_aggregate())


@query("udaf_hop", hop_sql("id", 6 * HOUR, 2 * HOUR, f"{_product_sql(_LISTED)} AS product"))
def udaf_hop(spark, folder):
    return aggregate_windows(sensor(spark, folder), keys=["id"], ts="ts", size="6 hours", slide="2 hours", **_user_aggregate())


@query(
    "udaf_running",
    f"""WITH {SENSOR}, held AS (SELECT user_id, seq, list(vc) OVER (PARTITION BY user_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS vs FROM sensor)
    SELECT user_id, seq, {_product_sql('vs')} AS product FROM held""",
)
def udaf_running(spark, folder):
    rows = sensor(spark, folder).select("user_id", "seq", "vc")
    user = {k: v for k, v in _user_aggregate().items() if k != "accumulate"}
    return running_aggregate(rows, keys=["user_id"], order=["seq"], lift=_lift, **user).select("user_id", "seq", "product")


@query(
    "udtaf_top2_changelog",
    f"""WITH {SENSOR}, l AS (SELECT id, seq, list_reverse_sort(list(vc) OVER (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING))[1:2] AS top
      FROM sensor WHERE vc IS NOT NULL),
    h AS (SELECT *, lag(top) OVER (PARTITION BY id ORDER BY seq) AS held FROM l),
    m AS (SELECT id, seq AS step, unnest([1, 2]) AS rank, top, held FROM h),
    c AS (SELECT id, step, rank, top[rank] AS new, held[rank] AS old FROM m WHERE top[rank] IS DISTINCT FROM held[rank])
    SELECT id, step, CAST(rank AS INTEGER) AS rank, false AS added, old AS value FROM c WHERE old IS NOT NULL
    UNION ALL SELECT id, step, CAST(rank AS INTEGER), true, new FROM c WHERE new IS NOT NULL""",
)
def udtaf_top2_changelog(spark, folder):
    rows = sensor(spark, folder).select("id", "seq", "vc").where("vc IS NOT NULL")
    return top_changelog(rows, keys=["id"], order=["seq"], value="vc")
