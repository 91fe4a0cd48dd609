"""Session features of a table.

A session is a chain of one key's rows, each at most ``gap`` after the one before.

Rows of a key that fall into the same span of ``gap`` milliseconds always share a session.
So rows are first aggregated by (key, span), on the map side and without sorting, and only
these parts meet per key: at most one for each gap of the time covered, however many rows a
key holds. Where the gap is short against the time covered, parts are chained per (key,
chunk of time) first, and only sessions near a chunk's edge go on to meet the key's others.
So a key with a third of all rows costs no task more than the length of history does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwelltide.durations import duration_ms
from dwelltide.functions.measures import (
    DEFAULT_MEASURES,
    Accumulator,
    Measure,
    typed,
    with_results,
)

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS


def span_start(event_ms: str, width_ms: int) -> Column:
    """Start of the fixed span that holds the time, also before 1970."""
    return F.expr(f"{event_ms} - pmod({event_ms}, {width_ms}L)")


def session_parts(
    rows: DataFrame,
    width_ms: int,
    key: str,
    event_ms: str,
    measures: Sequence[Measure],
    chunk_ms: int | None = None,
) -> DataFrame:
    """One row per key and span: first and last time, and every measure.

    Spans are cut at the borders of chunks, if there are any.
    """
    spans = [span_start(event_ms, width_ms).alias("span")]
    if chunk_ms:
        spans.append(span_start(event_ms, chunk_ms).alias("chunk"))
    return (
        rows.filter(F.col(event_ms).isNotNull())
        .groupBy(key, *spans)
        .agg(
            F.min(event_ms).alias("first_ms"),
            F.max(event_ms).alias("last_ms"),
            *[m.partial(event_ms) for m in measures],
        )
    )


def chained(
    parts: DataFrame, gap_ms: int, *keys: str, order: Sequence[str] = ("first_ms",)
) -> DataFrame:
    """Adds the start of the session that each part belongs to, within its group."""
    by_time = Window.partitionBy(*keys).orderBy(*order)
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = F.col("previous_ms").isNull() | (F.col("first_ms") - F.col("previous_ms") > gap_ms)
    # Named first: the optimizer would otherwise compute the lag once per use.
    return parts.select("*", F.lag("last_ms").over(by_time).alias("previous_ms")).select(
        "*", F.max(F.when(opens, F.col("first_ms"))).over(so_far).alias("session_ms")
    )


def merged(chains: DataFrame, measures: Sequence[Measure], *keys: str) -> DataFrame:
    """One row per group and session."""
    return chains.groupBy(*keys, "session_ms").agg(
        F.max("last_ms").alias("last_ms"), *[m.merge().alias(m.name) for m in measures]
    )


def chunk_sessions(
    rows: DataFrame,
    gap_ms: int,
    chunk_ms: int,
    key: str,
    event_ms: str,
    measures: Sequence[Measure],
) -> DataFrame:
    """Sessions within each chunk of a key, as parts of the key's sessions.

    ``lane`` is null for the at most two sessions of a chunk that may reach beyond it; every
    other session has a lane of its own, so that it need not meet them.
    """
    width = min(gap_ms, chunk_ms)
    parts = session_parts(rows, width, key, event_ms, measures, chunk_ms)
    inside = merged(chained(parts, gap_ms, key, "chunk"), measures, key, "chunk")
    whole = (F.col("session_ms") - F.col("chunk") >= gap_ms) & (
        F.col("last_ms") + gap_ms < F.col("chunk") + chunk_ms
    )
    return inside.withColumn("lane", F.when(whole, F.col("session_ms"))).withColumnRenamed(
        "session_ms", "first_ms"
    )


def feature_columns(gap_ms: int, key: str, measures: Sequence[Measure]) -> list[Column]:
    """The feature row of a session, from its start, last time and measures."""
    return [
        F.col(key),
        F.timestamp_millis("session_ms").alias("session_start"),
        F.timestamp_millis(F.col("last_ms") + gap_ms).alias("session_end"),
        F.col("session_ms").alias("first_recv_ts"),
        F.col("last_ms").alias("last_recv_ts"),
        *[m.finish() for m in measures],
    ]


def session_features(
    rows: DataFrame,
    gap: int | str,
    key: str = "device_id",
    event_ms: str = "recv_timestamp",
    measures: Sequence[Measure | Accumulator] = DEFAULT_MEASURES,
) -> DataFrame:
    """One row per session with its measures."""
    return with_results(
        _session_features(rows, duration_ms(gap), key, event_ms, typed(measures, rows.schema)),
        measures,
    )


def _session_features(
    rows: DataFrame, gap_ms: int, key: str, event_ms: str, measures: Sequence[Measure]
) -> DataFrame:
    if gap_ms >= HOUR_MS:
        parts = session_parts(rows, gap_ms, key, event_ms, measures)
        sessions = merged(chained(parts, gap_ms, key), measures, key)
        return sessions.select(*feature_columns(gap_ms, key, measures))
    # Sessions that lie inside a day meet nothing: only those near its border go on. Both
    # ways read the same shuffle.
    parts = chunk_sessions(rows, gap_ms, DAY_MS, key, event_ms, measures)
    names = [key, "session_ms", "last_ms", *[m.name for m in measures]]
    whole = parts.filter("lane IS NOT NULL").withColumnRenamed("first_ms", "session_ms")
    near = parts.filter("lane IS NULL")
    joined = merged(chained(near, gap_ms, key), measures, key)
    sessions = whole.select(*names).unionByName(joined.select(*names))
    return sessions.select(*feature_columns(gap_ms, key, measures))
