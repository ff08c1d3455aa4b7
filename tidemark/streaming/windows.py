"""Structured Streaming analogues: re-reading with an overlap (I-08), and the latest state of each key (W-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overlap_start(last_as_of: Column, days: int = 21) -> Column:
    """I-08: from which day on a run reads again: `days` before the last run's day."""
    return F.date_sub(last_as_of, days)


def fresh_rows(stream: DataFrame, key: list[str], time: str, delay: str = "21 days") -> DataFrame:
    """I-08: rows of a stream, each key once within `delay`; later repeats are dropped, state older than that is let go."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def counted(stream: DataFrame, time: str, by: list[str], width: str, delay: str) -> DataFrame:
    """Rows per window of event time and key, final once the watermark has passed."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), *by).agg(F.count(F.lit(1)).alias("n"))
