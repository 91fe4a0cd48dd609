"""Projections and the view filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def device_input(events: DataFrame, *keep: str) -> DataFrame:
    """Device, view time (0 where missing) and receive time; other columns are pruned."""
    return events.select(
        *keep,
        "device_id",
        F.coalesce("view_time", F.lit(0)).cast("bigint").alias("view_time"),
        "recv_timestamp",
    )


def with_event_time(
    events: DataFrame, delay: str, column: str = "et", event_ms: str | Column = "recv_timestamp"
) -> DataFrame:
    """Event time from a time in milliseconds, by default the receive time, with its lateness
    bound. ``event_ms`` is a column's name, or an expression of one's own.

    The watermark is the maximum over all partitions and all sources of ``events``, so an
    idle partition or an idle source of a union never holds it back.
    """
    timed = events.withColumn(column, F.timestamp_millis(event_ms))
    return timed.withWatermark(column, delay)


def viewed(event_time: str | None = None) -> Column:
    """True for rows with a positive view time; a missing one counts as zero.

    On a stream name the event time column: a predicate that mentions it stays above the
    watermark, so that rows without views still advance event time. Without it Catalyst
    pushes the filter into the scan, which is what a table wants.
    """
    keep = F.col("view_time") > 0
    return keep if event_time is None else F.when(F.col(event_time).isNotNull(), keep)


def view_input(events: DataFrame) -> DataFrame:
    """Device input of a table, rows with views only."""
    return device_input(events.filter(viewed()))


def client_versions(logs: DataFrame) -> DataFrame:
    return logs.select("platform", "version")
