"""Session features of a stream with early results.

After every micro-batch each session that changed is emitted with its running values, and
once more when it closes. Spark's own session windows cannot do that (no update mode), so
this is a stateful processor. Before the shuffle, rows are aggregated to partial sessions
per Arrow batch, so a key that holds much of a micro-batch reaches its task as a few rows.
State is kept per group of keys.

A row is late, and dropped, only if the session it would belong to has ended at the
watermark. Rows of one micro-batch are joined to each other and to the open sessions first,
so the result does not depend on their order within the micro-batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from dwelltide.durations import duration_ms
from dwelltide.functions.measures import (
    DEFAULT_MEASURES,
    WHOLE,
    Accumulator,
    Measure,
    Merged,
    typed,
    with_results,
)

# Executors need not have this module installed: it travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A session in state and on its way there is a row: first time, last time, then the slots of
# every measure. A latest value has two slots, its time and itself.
FIRST, LAST, SLOTS = 0, 1, 2

LIVE, CLOSED, ABSORBED, LATE = "live", "closed", "absorbed", "late"

# What stands in a slot on its way to the processor and back.
PRESENT, MISSING, NOT_A_NUMBER = "0", "1", "2"

#: Groups of keys, by hash. A micro-batch reads and writes the groups that it touches: with some
#: hundreds of keys each that costs no more than the messages of a key by itself.
GROUPS = 8192


def slot_names(measures: Sequence[Measure]) -> list[str]:
    names = []
    for m in measures:
        names += [f"{m.name}_at", m.name] if m.kind == "latest" else [m.name]
    return names


def slot_types(measures: Sequence[Measure]) -> list[str]:
    types = []
    for m in measures:
        types += [WHOLE, m.type] if m.kind == "latest" else [m.type]
    return types


def partial_rows(gap_ms: int, key: str, event_ms: str, measures: Sequence[Measure]):
    """A ``mapInArrow`` function: per Arrow batch, one row per key and span of ``gap_ms``."""
    plain = [(m.kind, m.column) for m in measures if m.kind != "latest"]
    latest = [m.column for m in measures if m.kind == "latest"]
    plan = [(m.kind, m.column) for m in measures]

    def run(batches: Iterator[Any]) -> Iterator[Any]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def newest_last(table: Any, column: str) -> Any:
            present = pc.if_else(table[column].is_valid(), table["_time"], None)
            return table.append_column("_at", present).sort_by(
                [(name, "ascending") for name in ("_code", "_span", "_time", column)]
            )

        def grouped(table: Any, aggregates: list) -> Any:
            # Single-threaded, so that "last" means last and groups stay in order.
            return table.group_by(["_code", "_span"], use_threads=False).aggregate(aggregates)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = batch.column(key).dictionary_encode()
            times = batch.column(event_ms)
            spans = pa.array(np.floor_divide(times.to_numpy(), gap_ms))
            inputs = {c: batch.column(c) for _, c in plan if c is not None}
            table = pa.table({**inputs, "_code": keys.indices, "_span": spans, "_time": times})
            table = table.sort_by([("_code", "ascending"), ("_span", "ascending")])

            wanted = [("_time", "min"), ("_time", "max"), ([], "count_all")]
            wanted += [(column, kind) for kind, column in dict.fromkeys(plain) if column]
            main = grouped(table, wanted)
            newest = {
                c: grouped(newest_last(table, c), [("_at", "last"), (c, "last")])
                for c in dict.fromkeys(latest)
            }
            columns = [keys.dictionary.take(main["_code"].combine_chunks())]
            columns += [main["_time_min"], main["_time_max"]]
            for kind, column in plan:
                if kind == "latest":
                    columns += [newest[column]["_at_last"], newest[column][f"{column}_last"]]
                else:
                    columns.append(main[f"{column}_{kind}" if column else "count_all"])
            names = [key, "first_ms", "last_ms"] + [f"slot_{i}" for i in range(len(columns) - 3)]
            yield from pa.Table.from_arrays(columns, names=names).to_batches()

    return run


def merge_slots(left: list, right: list, kinds: Sequence[str]) -> list:
    """Measures of two parts of a session, in place of the measures of one."""
    merged, at = [], 0
    for kind in kinds:
        a, b = left[at], right[at]
        if kind == "latest":
            pairs = [(s[at], s[at + 1]) for s in (left, right) if s[at] is not None]
            merged += max(pairs) if pairs else (None, None)
            at += 2
            continue
        if a is None or b is None:
            merged.append(b if a is None else a)
        elif kind in ("sum", "count"):
            merged.append(a + b)
        else:
            merged.append(min(a, b) if kind == "min" else max(a, b))
        at += 1
    return merged


def merge_two(left: list, right: list, kinds: Sequence[str]) -> list:
    return [
        min(left[FIRST], right[FIRST]),
        max(left[LAST], right[LAST]),
        *merge_slots(left[SLOTS:], right[SLOTS:], kinds),
    ]


def merge_sessions(
    live: Sequence[list], arrived: Sequence[list], gap_ms: int, kinds: Sequence[str]
) -> list[tuple[list, list[int], bool]]:
    """Chains live sessions and newly arrived parts that are at most a gap apart.

    Gives (session, starts of the live sessions in it, whether anything arrived).
    """
    parts = sorted(
        [(part, True) for part in arrived] + [(session, False) for session in live],
        key=lambda item: item[0][FIRST],
    )
    chains: list[tuple[list, list[int], bool]] = []
    for part, new in parts:
        starts = [] if new else [part[FIRST]]
        if chains and part[FIRST] - chains[-1][0][LAST] <= gap_ms:
            session, members, changed = chains[-1]
            chains[-1] = (merge_two(session, part, kinds), members + starts, changed or new)
        else:
            chains.append((list(part), starts, new))
    return chains


class SessionProcessor(StatefulProcessor):
    """Open sessions of a group of keys, with a timer at the earliest end.

    Each read and write of state is a message to the JVM and back, so they are per group and not
    per key. Extending a session leaves the timer alone; a timer that finds nothing ended is
    set again. Results leave group by group, however many end at once.
    """

    def __init__(
        self,
        gap_ms: int,
        kinds: Sequence[str],
        columns: Sequence[str],
        session: str,
        early: bool,
    ) -> None:
        self.gap_ms = gap_ms
        self.session = session
        self.columns = tuple(columns)
        self.kinds = tuple(kinds)
        self.early = early

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "open", f"sessions array<struct<name:string,{self.session}>>, timer bigint"
        )

    def _ended(self, session: list, watermark: int) -> bool:
        return session[LAST] + self.gap_ms <= watermark

    def _stored(self) -> tuple[dict[str | None, list[list]], int | None]:
        stored, sessions = self.state.get(), {}
        for name, *session in stored[0] if stored else ():
            sessions.setdefault(name, []).append(session)
        return sessions, stored[1] if stored else None

    def _keep(self, sessions: dict[str | None, list[list]], timer: int | None) -> None:
        kept = [(name, *session) for name, own in sessions.items() for session in own]
        if not kept:
            self.state.clear()
            return
        first_end = min(session[1 + LAST] for session in kept) + self.gap_ms
        if timer is None or first_end < timer:
            self.handle.registerTimer(first_end)
            timer = first_end
        self.state.update((kept, timer))

    def _results(self, found: list[tuple[str | None, list, str]]) -> Iterator[Any]:
        """As a table without nulls in numbers, which pandas would make fractions of them."""
        import pandas as pd

        rows = []
        for name, (first, last, *slots), status in found:
            marks = "".join(MISSING if x is None else NOT_A_NUMBER if x != x else PRESENT for x in slots)
            filled = [x if mark == PRESENT else 0 for x, mark in zip(slots, marks)]
            rows.append((name, marks, first, last, *filled, status))
        if rows:
            yield pd.DataFrame(rows, columns=list(self.columns))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Any]:
        watermark = timerValues.getCurrentWatermarkInMs()

        # However many rows come, at most one part per key and span is held.
        arrived: dict[str | None, dict[int, list]] = {}
        for table in rows:
            for _, name, marks, *part in table.itertuples(index=False, name=None):
                if MISSING in marks:
                    part[SLOTS:] = [None if m == MISSING else x for x, m in zip(part[SLOTS:], marks)]
                # A null among strings may have become NaN.
                spans = arrived.setdefault(name if isinstance(name, str) else None, {})
                span = part[FIRST] // self.gap_ms
                known = spans.get(span)
                spans[span] = part if known is None else merge_two(known, part, self.kinds)

        stored, timer = self._stored()
        found = []
        for name, spans in arrived.items():
            # What ended before this micro-batch takes no more rows.
            sessions = stored.get(name, [])
            found += [(name, s, CLOSED) for s in sessions if self._ended(s, watermark)]
            live = [s for s in sessions if not self._ended(s, watermark)]
            kept = []
            for session, members, changed in merge_sessions(
                live, list(spans.values()), self.gap_ms, self.kinds
            ):
                if not members and self._ended(session, watermark):
                    found.append((name, session, LATE))
                    continue
                kept.append(session)
                if changed and self.early:
                    found.append((name, session, LIVE))
                    for start in members:
                        if start != session[FIRST]:
                            absorbed = [start, start] + [None] * (len(session) - SLOTS)
                            found.append((name, absorbed, ABSORBED))
            stored[name] = kept
        self._keep(stored, timer)
        yield from self._results(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Any]:
        stored, timer = self._stored()
        if timer != expiredTimerInfo.getExpiryTimeInMs():
            return
        watermark = timerValues.getCurrentWatermarkInMs()
        found = []
        for name, sessions in stored.items():
            found += [(name, s, CLOSED) for s in sessions if self._ended(s, watermark)]
            stored[name] = [s for s in sessions if not self._ended(s, watermark)]
        self._keep(stored, None)
        yield from self._results(found)

    def close(self) -> None:
        pass


def _as_text(key: str, kind: str) -> Column:
    """A key as text, from which ``_from_text`` makes the key again."""
    if kind == "binary":
        return F.hex(key)
    return F.col(key).cast("string") if kind != "timestamp" else F.unix_micros(key).cast("string")


def _from_text(text: str, kind: str) -> Column:
    if kind == "binary":
        return F.unhex(text)
    return F.col(text).cast(kind) if kind != "timestamp" else F.timestamp_micros(F.col(text).cast("bigint"))


def early_sessions(
    timed: DataFrame,
    gap: int | str,
    key: str = "device_id",
    event_ms: str = "recv_timestamp",
    measures: Sequence[Measure | Accumulator] = DEFAULT_MEASURES,
    early: bool = True,
    mode: str = "update",
    groups: int = GROUPS,
) -> DataFrame:
    """Session features for output mode update, or ``mode``, from rows with a watermark.

    Besides the features, ``closed`` marks a session's last result and ``absorbed`` the
    start of a session that became part of another, to be deleted downstream. With ``early``
    off only closed sessions come out. Late rows are counted, as the sessions they would
    have made, in the metric ``late``. State is kept per hash group of keys; their number ``groups``
    stays as it is while the checkpoint lives.
    """
    if any(isinstance(m, Merged) for m in measures):
        raise ValueError("the keyed state merges in Python: keep open sessions in a table for these measures")
    gap_ms, given, measures = duration_ms(gap), measures, typed(measures, timed.schema)
    names, types = slot_names(measures), [WHOLE, WHOLE, *slot_types(measures)]
    key_type = timed.schema[key].dataType.simpleString()
    # A column that is only counted need not be a number.
    inputs = {
        m.column: F.when(F.col(m.column).isNotNull(), F.lit(1)).cast(WHOLE)
        for m in measures
        if m.kind == "count" and m.column not in (None, event_ms)
    }
    inputs |= {
        m.column: F.col(m.column).cast(m.type)
        for m in measures
        if m.kind != "count" and m.column != event_ms
    }
    slots = ["first_ms", "last_ms", *[f"slot_{i}" for i in range(len(names))]]
    layout = f"`{key}` {key_type}, " + ", ".join(f"{n} {t}" for n, t in zip(slots, types))
    session = ",".join(f"{n}:{t}" for n, t in zip(slots, types))

    parts = (
        timed.filter(F.col(event_ms).isNotNull())
        .select(
            key,
            F.col(event_ms).cast("bigint"),
            *[column.alias(name) for name, column in inputs.items()],
        )
        .mapInArrow(partial_rows(gap_ms, key, event_ms, measures), layout)
    )
    own = dict(zip(slots[2:], types[2:]))
    marks = [F.when(F.col(c).isNull(), MISSING).otherwise(PRESENT) for c in own]
    sent = parts.select(_as_text(key, key_type).alias("name"), *slots).select(
        F.pmod(F.xxhash64("name"), F.lit(groups)).alias("group"), "name", F.concat(*marks).alias("marks"),
        "first_ms", "last_ms", *[F.coalesce(c, F.lit(0).cast(t)).alias(c) for c, t in own.items()],
    )
    columns = ["name", "marks", *slots, "status"]
    processor = SessionProcessor(gap_ms, [m.kind for m in measures], columns, session, early)
    numbers = ", ".join(f"{n} {t}" for n, t in zip(slots, types))
    answered = sent.groupBy("group").transformWithStateInPandas(
        processor, f"name string, marks string, {numbers}, status string", mode, "eventTime"
    )

    def restored(place: int, column: str, kind: str) -> Column:
        mark = F.substring("marks", place + 1, 1)
        number = F.when(mark == PRESENT, F.col(column))
        return number.when(mark == NOT_A_NUMBER, F.lit(float("nan"))) if kind == "double" else number

    emitted = answered.select(
        _from_text("name", key_type).alias(key), "first_ms", "last_ms", "status",
        *[restored(i, c, t).alias(c) for i, (c, t) in enumerate(own.items())],
    )
    absorbed, late = F.col("status") == ABSORBED, F.col("status") == LATE
    on_time = emitted.observe("late", F.count_if(late).alias("sessions")).filter(~late)
    found = on_time.select(
        key,
        F.timestamp_millis("first_ms").alias("session_start"),
        F.when(~absorbed, F.timestamp_millis(F.col("last_ms") + gap_ms)).alias("session_end"),
        F.when(~absorbed, F.col("first_ms")).alias("first_recv_ts"),
        F.when(~absorbed, F.col("last_ms")).alias("last_recv_ts"),
        *[F.col(f"slot_{names.index(m.name)}").alias(m.name) for m in measures],
        (F.col("status") == CLOSED).alias("closed"),
        absorbed.alias("absorbed"),
    )
    return with_results(found, given)
