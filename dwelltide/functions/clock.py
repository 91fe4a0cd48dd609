"""Ingest latency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lag_seconds(event_ms: str, now_ms: int | None = None) -> Column:
    """Whole seconds from event time to now, truncated toward zero.

    Without a given clock, the time of the query, or of the micro-batch, is taken.
    """
    now = f"{now_ms}L" if now_ms is not None else "unix_millis(current_timestamp())"
    return F.expr(f"({now} - {event_ms}) div 1000")
