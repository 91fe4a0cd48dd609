"""Final session features of a stream: each session once, after it has closed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwelltide.durations import duration_ms, interval
from dwelltide.functions.measures import DEFAULT_MEASURES, Accumulator, Measure, typed, with_results
from dwelltide.operators.sessions import feature_columns
from dwelltide.streaming.early import GROUPS, early_sessions


def closed_sessions(
    timed: DataFrame,
    gap: int | str,
    key: str = "device_id",
    event_ms: str = "recv_timestamp",
    event_time: str = "et",
    measures: Sequence[Measure | Accumulator] = DEFAULT_MEASURES,
) -> DataFrame:
    """Session features for output mode append, on Spark's own session windows.

    A row is dropped as late when its own window, time to time + gap, has ended, even if it
    would touch a session that is still open; ``merged_sessions`` keeps such a row. Spark
    applies a new limit one micro-batch after it is known, so some rows get one more chance.
    """
    given, measures = measures, typed(measures, timed.schema)
    found = (
        timed.groupBy(key, F.session_window(event_time, interval(gap)))
        .agg(
            F.min(event_ms).alias("session_ms"),
            F.max(event_ms).alias("last_ms"),
            *[m.partial(event_ms) for m in measures],
        )
        .select(*feature_columns(duration_ms(gap), key, measures))
    )
    return with_results(found, given)


def merged_sessions(
    timed: DataFrame,
    gap: int | str,
    key: str = "device_id",
    event_ms: str = "recv_timestamp",
    measures: Sequence[Measure | Accumulator] = DEFAULT_MEASURES,
    groups: int = GROUPS,
) -> DataFrame:
    """The same, but a row is late only if the session that it would join, once merged, had
    ended. For output mode append, from the keyed state of the early results."""
    found = early_sessions(timed, gap, key, event_ms, measures, early=False, mode="append", groups=groups)
    return found.drop("closed", "absorbed")
