"""CSV file sink."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).csv(path)


def stream_csv(df: DataFrame, path: str, checkpoint: str):
    """Append a stream to CSV files; the checkpoint makes each batch appear once."""
    return (
        df.writeStream.format("csv").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
