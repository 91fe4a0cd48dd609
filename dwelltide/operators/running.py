"""Running session values of a table: what early results show, interval by interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwelltide.durations import duration_ms
from dwelltide.functions.measures import DEFAULT_MEASURES, Accumulator, Measure, typed, with_results
from dwelltide.operators.sessions import chained, chunk_sessions, session_parts, span_start

# Most intervals of one key that a window group may hold: an hour at one millisecond.
TICKS_PER_CHUNK = 3_600_000

CARRIED_FIRST = ("first_ms", "is_tick")


def running_sessions(
    rows: DataFrame,
    gap: int | str,
    every: int | str = 1,
    key: str = "device_id",
    event_ms: str = "recv_timestamp",
    measures: Sequence[Measure | Accumulator] = DEFAULT_MEASURES,
) -> DataFrame:
    """Each session's value after every interval in which it changed.

    ``every`` is the interval between early results; at one millisecond there is one row
    per key and event time.

    A key's history is cut into chunks of time. What a session held before a chunk comes from
    the sessions at the edges of chunks and stands, as one more row, before its intervals in
    the chunk. So running values are windows per (key, chunk), and none holds all rows of a
    key.
    """
    gap_ms, every_ms = duration_ms(gap), duration_ms(every)
    given, measures = measures, typed(measures, rows.schema)
    if every_ms > gap_ms:
        raise ValueError("early results cannot be farther apart than the session gap")
    chunk_ms = every_ms * TICKS_PER_CHUNK

    earlier = (
        Window.partitionBy(key, "lane", "session_ms")
        .orderBy("first_ms")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = chunk_sessions(rows, gap_ms, chunk_ms, key, event_ms, measures)
    carried = chained(parts, gap_ms, key, "lane").select(
        key,
        "chunk",
        "first_ms",
        F.col("first_ms").alias("last_ms"),
        F.col("session_ms").alias("start_ms"),
        F.lit(False).alias("is_tick"),
        *[m.merge().over(earlier).alias(m.name) for m in measures],
    )
    ticks = session_parts(rows, every_ms, key, event_ms, measures).select(
        key,
        span_start("span", chunk_ms).alias("chunk"),
        "first_ms",
        "last_ms",
        F.lit(None).cast("bigint").alias("start_ms"),
        F.lit(True).alias("is_tick"),
        *[m.name for m in measures],
    )

    in_chunk = chained(carried.unionByName(ticks), gap_ms, key, "chunk", order=CARRIED_FIRST)
    inside = (
        Window.partitionBy(key, "chunk", "session_ms")
        .orderBy(*CARRIED_FIRST)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = in_chunk.select(
        key,
        "is_tick",
        F.min("start_ms").over(inside).alias("start_ms"),
        F.col("last_ms").alias("as_of_ts"),
        *[m.merge().over(inside).alias(m.name) for m in measures],
    ).filter("is_tick")
    found = running.select(
        key,
        F.timestamp_millis("start_ms").alias("session_start"),
        "as_of_ts",
        *[m.finish() for m in measures],
    )
    return with_results(found, given)
