"""Sources, sinks and codecs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from data import feed, frame, skewed, split, tuples
from weirstone import schemas
from weirstone.session import scratch, shared_root
from weirstone.sinks.files import stream_csv, write_csv
from weirstone.sinks.jdbc import merge_sql, upsert_rows
from weirstone.sinks.keyed import UpsertLog, documents
from weirstone.sinks.rowwriter import JsonLineWriter
from weirstone.sources import kafka
from weirstone.sources.codecs import decode_csv, decode_json
from weirstone.sources.files import delimited, text_lines
from weirstone.sources.lines import LineSource
from weirstone.sources.tables import declare_csv, save_to_catalog, scan_catalog
from weirstone.streaming.runner import appended_rows, drain

LINES = "a,100,45\nb,115,43\nc,120,42\n\na,101,1\nb,101,2\n"
ROWS = [("a", 100, 45), ("a", 101, 1), ("b", 101, 2), ("b", 115, 43), ("c", 120, 42)]


@pytest.fixture
def sensor_file(folder):
    path = f"{folder}/sensor"
    os.makedirs(path)
    with open(f"{path}/part.txt", "w") as f:
        f.write(LINES)
    return path


def test_delimited_drops_blank_lines(spark, sensor_file):
    df = delimited(spark, sensor_file, schemas.SENSOR)
    assert df.schema == schemas.SENSOR
    assert tuples(df, "id", "ts", "vc") == ROWS
    assert tuples(delimited(spark, f"{sensor_file}/part.txt", schemas.SENSOR), "id", "ts", "vc") == ROWS


def test_malformed_line_fails_unless_allowed(spark, folder):
    with open(f"{folder}/bad.txt", "w") as f:
        f.write("a,1,2\nb,x,3\n")
    with pytest.raises(Exception, match="FAILFAST|FAILED_READ_FILE"):
        delimited(spark, folder, schemas.SENSOR).select("id").collect()
    assert tuples(delimited(spark, folder, schemas.SENSOR, malformed="DROPMALFORMED"), "id") == [("a",)]


def test_text_and_stream_of_text(spark, sensor_file):
    assert text_lines(spark, sensor_file).count() == 6
    assert appended_rows(text_lines(spark, sensor_file, stream=True)).count() == 6


def test_declared_table(spark, sensor_file):
    declare_csv(spark, "t_sensor", sensor_file, schemas.SENSOR)
    got = spark.sql("SELECT id, count(ts) AS ct, sum(vc) AS s FROM t_sensor GROUP BY id")
    assert tuples(got, "id", "ct", "s") == [("a", 2, 46), ("b", 2, 45), ("c", 1, 42)]
    assert spark.table("t_sensor").schema == schemas.SENSOR


def test_catalog_table(spark):
    save_to_catalog(spark.createDataFrame(ROWS, schemas.SENSOR), "t_catalog", scratch(spark, "t"))
    assert tuples(scan_catalog(spark, "t_catalog"), "id", "ts", "vc") == ROWS


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_line_source_reads_each_line_once(spark, sensor_file, size):
    spark.dataSource.register(LineSource)
    df = (
        spark.read.format("lines_of").schema("id string, ts long, vc int").option("path", sensor_file)
        .option("splitBytes", size).load()
    )
    assert tuples(df, "id", "ts", "vc") == ROWS


def test_line_source_stream(spark, sensor_file):
    spark.dataSource.register(LineSource)
    stream = spark.readStream.format("lines_of").schema("id string, ts long, vc int").option("path", sensor_file).load()
    assert tuples(appended_rows(stream), "id", "ts", "vc") == ROWS


def test_codecs(spark):
    text = spark.createDataFrame([('{"id":"a","ts":1,"vc":2}',)], "value string")
    assert tuples(decode_json(text, "value", schemas.SENSOR), "id", "ts", "vc") == [("a", 1, 2)]
    text = spark.createDataFrame([("a,1,2",)], "value string")
    assert tuples(decode_csv(text, "value", schemas.SENSOR), "id", "ts", "vc") == [("a", 1, 2)]
    rows = spark.createDataFrame(ROWS[:1], schemas.SENSOR)
    assert kafka.message_values(rows, ["id", "ts", "vc"]).first()[0] == '{"id":"a","ts":100,"vc":45}'
    assert kafka.message_values(rows, ["id", "ts", "vc"], "csv").first()[0] == "a,100,45"


def test_kafka_options():
    assert kafka.source_options("h:1", "t", group="g", max_offsets=5) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest", "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "5",
    }
    assert kafka.sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_csv_sink(spark, folder):
    write_csv(spark.createDataFrame(ROWS, schemas.SENSOR), f"{folder}/out")
    assert tuples(delimited(spark, f"{folder}/out", schemas.SENSOR), "id", "ts", "vc") == ROWS
    stream = delimited(spark, f"{folder}/out", schemas.SENSOR, stream=True).where("id = 'a'")
    stream_csv(stream, f"{folder}/copy", f"{folder}/cp").awaitTermination()
    assert tuples(delimited(spark, f"{folder}/copy", schemas.SENSOR), "id", "vc") == [("a", 1), ("a", 45)]


def test_upsert_log_is_idempotent(spark, folder):
    log = UpsertLog(f"{folder}/log", ["id"], order=["ts"])
    one = spark.createDataFrame(ROWS, schemas.SENSOR)
    two = spark.createDataFrame([("a", 50, 9), ("d", 1, 1)], schemas.SENSOR)
    for _ in range(2):
        log.write(one, 0)
        log.write(two, 1)
    want = [("a", 50, 9), ("b", 115, 43), ("c", 120, 42), ("d", 1, 1)]
    assert tuples(log.read(spark), "id", "ts", "vc") == want
    assert tuples(log.compact(spark, f"{folder}/compact", 1).read(spark), "id", "ts", "vc") == want


def test_documents(spark):
    rows = spark.createDataFrame(ROWS[:1], schemas.SENSOR)
    with_id = documents(rows, ["ts", "vc"], id_columns=["id", "vc"]).first()
    assert with_id["_id"] == "a-45" and json.loads(with_id["_source"]) == {"ts": 100, "vc": 45}
    assert documents(rows, ["ts", "vc"]).columns == ["_source"]


def test_jdbc_statement_and_rows(spark):
    assert merge_sql("t", "t_stage", ["id"], ["id", "ts", "vc"]) == (
        "MERGE INTO t t USING t_stage s ON t.id = s.id WHEN MATCHED THEN UPDATE SET ts = s.ts, vc = s.vc"
        " WHEN NOT MATCHED THEN INSERT (id, ts, vc) VALUES (s.id, s.ts, s.vc)"
    )
    staged = upsert_rows(spark.createDataFrame(ROWS, schemas.SENSOR), ["id"], ["ts"])
    assert tuples(staged, "id", "ts") == [("a", 101), ("b", 115), ("c", 120)]


def test_row_writer_over_batches(spark, folder):
    rows = skewed(60)
    stream = feed(spark, f"{folder}/in", split(rows, 2)).select("seq", "id")
    query = (
        stream.writeStream.foreach(JsonLineWriter(f"{folder}/out", ["seq", "id"]))
        .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.schema("seq long, id string").json(f"{folder}/out")
    assert tuples(got, "seq", "id") == sorted(((r[0], r[1]) for r in rows), key=str)


def test_row_writer_leaves_nothing_after_an_error(folder):
    writer = JsonLineWriter(f"{folder}/out", ["seq"])
    assert writer.open(0, 0)
    writer.process({"seq": 1})
    writer.close(RuntimeError("lost"))
    assert [n for n in os.listdir(f"{folder}/out") if not n.startswith("_")] == []


def test_shared_root_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x").startswith(shared_root(spark))


def test_stream_upserts(spark, folder):
    rows = skewed(120)
    log = UpsertLog(f"{folder}/log", ["id"], order=["seq"])
    drain(feed(spark, f"{folder}/in", split(rows, 3)), log.write, mode="append")
    last = {r[1]: r[3] for r in rows}
    assert tuples(log.read(spark), "id", "vc") == sorted(last.items(), key=str)
    assert frame(spark, rows).count() == 120
