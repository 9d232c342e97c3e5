"""Registered queries: sources, payload codecs and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.plans.inputs import SENSOR, sensor, sensor_stream
from weirstone.plans.registry import query
from weirstone.schemas import SENSOR as SENSOR_LINE, struct
from weirstone.session import scratch
from weirstone.sinks.files import write_csv
from weirstone.sinks.jdbc import upsert_rows
from weirstone.sinks.keyed import documents
from weirstone.sinks.rowwriter import JsonLineWriter
from weirstone.operators.rolling import last_per_key
from weirstone.sources.codecs import decode_csv, decode_json, encode_csv, encode_json
from weirstone.sources.files import delimited, table, table_stream, text_lines
from weirstone.sources.lines import LineSource
from weirstone.sources.tables import as_view, declare_csv, save_to_catalog, scan_catalog
from weirstone.streaming.runner import latest_rows, run_available

LINE_ROWS = "SELECT id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts, CAST(vc AS INTEGER) AS vc FROM sensor"


def _sensor_lines(spark, folder):
    """Events as `id,epoch seconds,vc` rows."""
    return sensor(spark, folder).select(
        "id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"), F.col("vc").cast("int").alias("vc")
    )


def _csv_files(spark, folder, label):
    path = scratch(spark, label)
    write_csv(_sensor_lines(spark, folder), path)
    return path


@query("scan_text", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def scan_text(spark, folder):
    path = scratch(spark, "text")
    table(spark, folder, "documents").select("text").write.text(path)
    return text_lines(spark, path)


@query("scan_csv_sensor", f"WITH {SENSOR} {LINE_ROWS}")
def scan_csv_sensor(spark, folder):
    return delimited(spark, _csv_files(spark, folder, "csv"), SENSOR_LINE)


@query(
    "scan_collection",
    "SELECT event_type, weight, count(*) AS n, CAST(count(*) * weight AS BIGINT) AS score FROM events"
    " JOIN (VALUES ('view', 1), ('click', 2), ('purchase', 5)) w(kind, weight) ON event_type = kind"
    " GROUP BY event_type, weight",
)
def scan_collection(spark, folder):
    weights = spark.createDataFrame(
        [("view", 1), ("click", 2), ("purchase", 5)], struct("event_type string, weight int")
    )
    counts = table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(weights, "event_type").select(
        "event_type", "weight", "n", (F.col("n") * F.col("weight")).alias("score")
    )


@query(
    "table_csv_agg",
    f"WITH {SENSOR} SELECT id, count(*) AS ct, CAST(sum(vc) AS BIGINT) AS vc_sum FROM sensor GROUP BY id",
)
def table_csv_agg(spark, folder):
    declare_csv(spark, "sensor_csv", _csv_files(spark, folder, "table"), SENSOR_LINE)
    return spark.sql("SELECT id, count(ts) AS ct, sum(vc) AS vc_sum FROM sensor_csv GROUP BY id")


@query("decode_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def decode_json_props(spark, folder):
    return decode_json(
        table(spark, folder, "events"), "props", struct("k int"), keep=["event_id"]
    )


@query("decode_csv", f"WITH {SENSOR} {LINE_ROWS}")
def decode_csv_lines(spark, folder):
    lines = _sensor_lines(spark, folder).select(encode_csv(["id", "ts", "vc"]).alias("value"))
    return decode_csv(lines, "value", SENSOR_LINE)


@query(
    "view_sql",
    f"WITH {SENSOR} SELECT id, count(*) AS ct, max(vc) AS max_vc FROM sensor GROUP BY id",
)
def view_sql(spark, folder):
    as_view(sensor(spark, folder), "sensor_view")
    return spark.sql("SELECT id, count(*) AS ct, max(vc) AS max_vc FROM sensor_view GROUP BY id")


@query("catalog_scan", "SELECT o_orderstatus, count(*) AS ct FROM orders GROUP BY o_orderstatus")
def catalog_scan(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    path = scratch(spark, "catalog")
    name = "weirstone_" + path.rpartition("-")[2]
    save_to_catalog(rows, name, path)
    return scan_catalog(spark, name).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("ct"))


@query("custom_source", f"WITH {SENSOR} {LINE_ROWS}")
def custom_source(spark, folder):
    spark.dataSource.register(LineSource)
    path = _csv_files(spark, folder, "lines")
    return spark.read.format(LineSource.name()).schema(SENSOR_LINE).option("path", path).load()


@query("sink_csv_roundtrip", f"WITH {SENSOR} {LINE_ROWS} WHERE id = 'view'")
def sink_csv_roundtrip(spark, folder):
    path = scratch(spark, "out")
    write_csv(_sensor_lines(spark, folder).where("id = 'view'"), path)
    return delimited(spark, path, SENSOR_LINE)


_JSON = (
    """'{"id":"' || id || '","ts":' || CAST(epoch_us(ts) // 1000000 AS VARCHAR) || ',"vc":' || CAST(vc AS VARCHAR) || '}'"""
)


@query("encode_json", f"WITH {SENSOR} SELECT {_JSON} AS value FROM sensor")
def encode_json_rows(spark, folder):
    return _sensor_lines(spark, folder).select(encode_json(["id", "ts", "vc"]).alias("value"))


@query(
    "encode_csv",
    f"WITH {SENSOR} SELECT id || ',' || CAST(epoch_us(ts) // 1000000 AS VARCHAR) || ',' || CAST(vc AS VARCHAR) AS value FROM sensor",
)
def encode_csv_rows(spark, folder):
    return _sensor_lines(spark, folder).select(encode_csv(["id", "ts", "vc"]).alias("value"))


@query("etl_csv_to_json", f"WITH {SENSOR} SELECT {_JSON} AS value FROM sensor WHERE id = 'click'")
def etl_csv_to_json(spark, folder):
    lines = _sensor_lines(spark, folder).select(encode_csv(["id", "ts", "vc"]).alias("value"))
    rows = decode_csv(lines, "value", SENSOR_LINE).where("id = 'click'")
    return rows.select(encode_json(["id", "ts", "vc"]).alias("value"))


_LATEST = f"WITH {SENSOR} SELECT user_id, arg_max(ts, seq) AS ts, arg_max(vc, seq) AS vc FROM sensor GROUP BY user_id"


@query("jdbc_upsert_rows", _LATEST)
def jdbc_upsert_rows(spark, folder):
    """The rows the JDBC upsert stages for its MERGE (no database is started for this)."""
    return upsert_rows(sensor(spark, folder), ["user_id"], ["seq"]).select("user_id", "ts", "vc")


@query(
    "sink_foreach",
    f"WITH {SENSOR} SELECT seq, id, vc FROM sensor",
)
def sink_foreach(spark, folder):
    path = scratch(spark, "foreach")
    rows, feed = sensor_stream(spark, folder)
    writer = rows.select("seq", "id", "vc").writeStream.foreach(JsonLineWriter(path, ["seq", "id", "vc"]))
    run_available(writer.option("checkpointLocation", scratch(spark, "checkpoint")), feed)
    return spark.read.schema("seq long, id string, vc long").json(path)


@query("latest_per_key", f"WITH {SENSOR} SELECT id, arg_max(vc, seq) AS vc FROM sensor GROUP BY id")
def latest_per_key(spark, folder):
    return last_per_key(sensor(spark, folder).select("id", "seq", "vc"), keys=["id"], order=["seq"]).select("id", "vc")


@query(
    "doc_rows",
    f"""WITH {SENSOR} SELECT id || '-' || CAST(seq AS VARCHAR) AS _id,
    '{{"user_id":' || CAST(user_id AS VARCHAR) || ',"vc":' || CAST(vc AS VARCHAR) || '}}' AS _source FROM sensor""",
)
def doc_rows(spark, folder):
    return documents(sensor(spark, folder), ["user_id", "vc"], id_columns=["id", "seq"])


@query(
    "upsert_agg_docs",
    f"""WITH {SENSOR}, g AS (SELECT id, user_id, count(*) AS ct FROM sensor GROUP BY id, user_id)
    SELECT id || '-' || CAST(user_id AS VARCHAR) AS _id, '{{"ct":' || CAST(ct AS VARCHAR) || '}}' AS _source FROM g""",
)
def upsert_agg_docs(spark, folder):
    rows, feed = sensor_stream(spark, folder)
    counts = rows.groupBy("id", "user_id").agg(F.count(F.lit(1)).alias("ct"))
    return documents(latest_rows(counts, keys=["id", "user_id"], feed=feed), ["ct"], id_columns=["id", "user_id"])
