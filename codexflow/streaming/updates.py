"""Incremental updates: lookback windows, change detection, and their streaming forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOOKBACK_DAYS = 3


def dates_to_fetch(last_success: Column, today: Column, back: int = LOOKBACK_DAYS) -> Column:
    """Days from ``back`` before the last success to today; without one, today alone."""
    begin = F.when(last_success.isNotNull(), F.least(F.date_sub(last_success, back), today)).otherwise(today)
    return F.sequence(begin, today)


def changed(force: Column, new: Column, complete: Column) -> Column:
    return force | (new > 0) | ~complete


def deduplicated(stream: DataFrame, keys: list[str], time_col: str, lateness: str = f"{LOOKBACK_DAYS} days") -> DataFrame:
    """Rows whose keys haven't come within the allowed lateness; batch frames are deduplicated as a whole."""
    if not stream.isStreaming:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(time_col, lateness).dropDuplicatesWithinWatermark(keys)


def tumbling(stream: DataFrame, time_col: str, size: str, keys: list[str], aggregates: list[Column], lateness: str = f"{LOOKBACK_DAYS} days") -> DataFrame:
    """Aggregates of fixed windows; an extension beside the batch operators."""
    held = stream.withWatermark(time_col, lateness) if stream.isStreaming else stream
    grouped = held.groupBy(F.window(time_col, size), *keys).agg(*aggregates)
    return grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *[c for c in grouped.columns if c not in ("window", *keys)])


def sessions(stream: DataFrame, time_col: str, gap: str, keys: list[str], aggregates: list[Column], lateness: str = f"{LOOKBACK_DAYS} days") -> DataFrame:
    """Aggregates of sessions that end after a gap."""
    held = stream.withWatermark(time_col, lateness) if stream.isStreaming else stream
    grouped = held.groupBy(F.session_window(time_col, gap), *keys).agg(*aggregates)
    return grouped.select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *keys, *[c for c in grouped.columns if c not in ("session_window", *keys)])
