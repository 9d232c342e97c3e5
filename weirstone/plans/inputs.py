"""How the tables stand in for the sensor, behaviour, login, order and click records.

Each view has a DataFrame and an SQL form (a CTE body) with the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weirstone.sources.files import table
from weirstone.streaming.feed import Feed

# Readings as whole numbers, so that sums do not depend on the order of adding.
SENSOR = (
    "sensor AS (SELECT event_id AS seq, event_type AS id, user_id, ts,"
    " CAST(round(value * 100) AS BIGINT) AS vc FROM events)"
)


def shape_sensor(events: DataFrame, *more: str) -> DataFrame:
    return events.select(
        F.col("event_id").alias("seq"), F.col("event_type").alias("id"), "user_id", "ts", F.round(F.col("value") * 100).cast("long").alias("vc"), *more
    )


def sensor(spark: SparkSession, folder: str) -> DataFrame:
    return shape_sensor(table(spark, folder, "events"))


def sensor_stream(spark: SparkSession, folder: str) -> tuple[DataFrame, Feed]:
    """Streaming sensor rows in order of arrival, and the feed that runs them.

    `ts` becomes TIMESTAMP, which watermarks need. A micro-batch is one slice of
    arrivals, as a key's rows of it may all pass through one task.
    """
    feed = Feed(spark, folder, "events", "event_id")
    return shape_sensor(feed.stream).withColumn("ts", F.col("ts").cast("timestamp")), feed


# Arrival disturbed on purpose: the table itself is in time order. Unique, since a
# multiple of 40 keeps event_id's remainder by 5.
JITTER = "jitter AS (SELECT event_id + 40 * (event_id % 5) AS seq, event_type AS id, user_id, ts, CAST(round(value * 100) AS BIGINT) AS vc FROM events)"


def jittered_id() -> Column:
    return F.col("event_id") + 40 * (F.col("event_id") % 5)


def jittered(spark: SparkSession, folder: str) -> DataFrame:
    return sensor(spark, folder).withColumn("seq", F.col("seq") + 40 * (F.col("seq") % 5))


PAYS = (
    "pays AS (SELECT user_id AS tx, event_id AS pay_id, ts AS pay_ts FROM events WHERE event_type = 'purchase'),"
    " receipts AS (SELECT user_id AS tx, event_id AS receipt_id, ts AS receipt_ts FROM events WHERE event_type = 'signup')"
)


def pays(events: DataFrame) -> DataFrame:
    return events.where("event_type = 'purchase'").select(
        F.col("user_id").alias("tx"), F.col("event_id").alias("pay_id"), F.col("ts").alias("pay_ts")
    )


def receipts(events: DataFrame) -> DataFrame:
    return events.where("event_type = 'signup'").select(
        F.col("user_id").alias("tx"), F.col("event_id").alias("receipt_id"), F.col("ts").alias("receipt_ts")
    )


def bare_words(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of every document, without its place."""
    return table(spark, folder, "documents").select(F.explode(F.split("text", "[ \n]")).alias("word")).where("word <> ''")


def word_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of every document with its place: (doc_id, pos, word)."""
    return (
        table(spark, folder, "documents")
        .select("doc_id", F.posexplode(F.split("text", "[ \n]")).alias("pos", "word"))
        .where("word <> ''")
        .withColumn("pos", F.col("pos").cast("long"))
    )


WORDS = (
    "parts AS (SELECT doc_id, regexp_split_to_array(text, '[ \n]') AS ws FROM documents),"
    " tokens AS (SELECT doc_id, unnest(ws) AS word, CAST(unnest(range(len(ws))) AS BIGINT) AS pos FROM parts),"
    " words AS (SELECT doc_id, pos, word FROM tokens WHERE word <> '')"
)


def access_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Access-log lines made from the events: one hit per event on a path per user."""
    stamp = F.date_format("ts", "dd/MM/yyyy:HH:mm:ss")
    method = F.when(F.col("event_type") == "error", "POST").otherwise("GET")
    line = F.concat(
        F.lit("10.0.0."), F.pmod("user_id", F.lit(256)).cast("string"), F.lit(" "), F.col("user_id").cast("string"),
        F.lit(" - "), stamp, F.lit(" +0000 "), method, F.lit(" /p/"), F.pmod("user_id", F.lit(37)).cast("string"),
    )
    return table(spark, folder, "events").select(F.col("event_id").alias("seq"), line.alias("line"))


def floored(width_us: int, ts: str = "ts") -> str:
    """SQL: start of the tumbling window of a timestamp."""
    return f"make_timestamp(epoch_us({ts}) - epoch_us({ts}) % {width_us})"


def paned(source: str, size_us: int, slide_us: int, ts: str = "ts") -> str:
    """SQL: each row of `source` once per sliding window, with its start `ws` (microseconds)."""
    last = f"(epoch_us({ts}) - epoch_us({ts}) % {slide_us})"
    lo = f"({last} - {size_us // slide_us * slide_us})"
    return (
        f"(SELECT * FROM (SELECT *, unnest(generate_series({lo}, {last}, {slide_us})) AS ws FROM {source})"
        f" WHERE ws <= epoch_us({ts}) AND ws + {size_us} > epoch_us({ts}))"
    )


HOUR = 3_600_000_000
MINUTE = 60_000_000
