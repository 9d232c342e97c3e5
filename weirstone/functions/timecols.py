"""Event-time columns and window labels as built-in expressions (UTC session)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros_of(duration: str | int) -> int:
    """'5 seconds' -> 5000000; an int is taken as microseconds already."""
    if isinstance(duration, int):
        return duration
    words = duration.split()
    if len(words) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    total = 0
    for amount, unit in zip(words[::2], words[1::2]):
        total += int(amount) * UNITS[unit.lower().removesuffix("s")]
    return total


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(col.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def floor_to(us: Column, width: Column | int) -> Column:
    """Largest multiple of `width` not above `us`."""
    w = F.lit(width) if isinstance(width, int) else width
    return us - F.pmod(us, w)


def event_time(ts: Column | str, unit: str = "seconds") -> Column:
    """Epoch seconds or milliseconds to TIMESTAMP."""
    col = F.col(ts) if isinstance(ts, str) else ts
    if unit == "seconds":
        return F.timestamp_seconds(col)
    if unit == "millis":
        return F.timestamp_millis(col)
    raise ValueError(unit)


def proctime() -> Column:
    """Ingest-time attribute: one value per query (per micro-batch in a stream)."""
    return F.current_timestamp()


def ddl_rowtime(ts: Column | str) -> Column:
    """Row-time of a declared table: epoch seconds via a formatted string."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.to_timestamp(F.from_unixtime(col, "yyyy-MM-dd HH:mm:ss"))


def local_day(ts: Column | str, offset_hours: int) -> Column:
    """Calendar day of a UTC time at a fixed offset, as a DATE."""
    us = epoch_micros(ts) + F.lit(offset_hours * UNITS["hour"])
    return from_micros(us).cast("date")
