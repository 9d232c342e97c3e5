"""Small fixtures: skewed rows made from a seed, and streams fed batch by batch."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

START = datetime(2024, 3, 1)
SCHEMA = "seq long, id string, ts timestamp, vc long"


def skewed(n: int = 1200, seed: int = 7, disorder: int = 0) -> list[tuple]:
    """(seq, id, ts, vc); half of the rows have id 'hot', a third share one hour."""
    rng = random.Random(seed)
    rows, at = [], START
    for seq in range(n):
        at += timedelta(seconds=rng.choice([1, 2, 3]) if n // 3 < seq < 2 * n // 3 else rng.choice([0, 1, 5, 40, 200]))
        name = "hot" if rng.random() < 0.5 else f"k{rng.randrange(12)}"
        shift = timedelta(seconds=rng.randrange(disorder + 1)) if disorder else timedelta()
        rows.append((seq, name, at - shift, rng.randrange(60)))
    return rows


def frame(spark, rows, schema: str = SCHEMA):
    return spark.createDataFrame(rows, schema)


def by_key(rows) -> dict[str, list[tuple]]:
    out: dict[str, list[tuple]] = {}
    for r in rows:
        out.setdefault(r[1], []).append(r)
    return out


def us(at: datetime) -> int:
    return round((at - datetime(1970, 1, 1)).total_seconds() * 1_000_000)


def feed(spark, folder: str, batches: list[list[tuple]], schema: str = SCHEMA):
    """A stream reading one file per micro-batch, in the order given."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        add_batch(spark, folder, i, rows, schema)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def add_batch(spark, folder: str, i: int, rows, schema: str = SCHEMA) -> None:
    part = f"{folder}-parts/{i}"
    frame(spark, rows, schema).coalesce(1).write.parquet(part)
    name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
    target = f"{folder}/{i:04d}.parquet"
    os.replace(f"{part}/{name}", target)
    stamp = 1_700_000_000 + i
    os.utime(target, (stamp, stamp))


def split(rows, n: int) -> list[list[tuple]]:
    size = -(-len(rows) // n)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


def shaped(df):
    """The columns the stateful processors expect."""
    return df.withColumn("_seq", F.col("seq")).withColumn("_us", F.unix_micros("ts"))


def sentinel(schema_len: int = 4):
    """A row far in the future that moves the watermark past everything."""
    return (10**9, "~end", START + timedelta(days=400), 0)


def tuples(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
