"""Kafka source and sink through Spark's connector (a package the cluster supplies)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirstone.sources.codecs import encode_csv, encode_json


def source_options(
    servers: str, topic: str, *, group: str | None = None, start: str = "latest", max_offsets: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
    }
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def string_stream(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    """Message values as UTF-8 strings, column `value`."""
    raw = spark.readStream.format("kafka").options(**source_options(servers, topic, **kwargs)).load()
    return raw.select(F.col("value").cast("string").alias("value"))


def message_values(df: DataFrame, columns: Sequence[str], format: str = "json") -> DataFrame:
    """Rows as message values; without a key the producer spreads them round-robin."""
    encode = {"json": encode_json, "csv": encode_csv}[format]
    return df.select(encode(columns).alias("value"))


def write_stream(df: DataFrame, servers: str, topic: str, checkpoint: str, columns: Sequence[str], format: str = "json"):
    values = message_values(df, columns, format)
    writer = values.writeStream.format("kafka").options(**sink_options(servers, topic))
    return writer.option("checkpointLocation", checkpoint).start()
