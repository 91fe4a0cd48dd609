"""Early results: running sessions of a stream."""

import random
from types import SimpleNamespace

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dwelltide.functions.measures import DEFAULT_MEASURES, Measure
from dwelltide.operators.project import with_event_time
from dwelltide.plans.device_features import running_features
from dwelltide.streaming.early import (
    SessionProcessor,
    early_sessions,
    merge_sessions,
    partial_rows,
    slot_names,
)
from tests.plain import plain_sessions
from tests.streams import HOUR, Feed, brief, run


def emitted(spark, feed, folder, gap="10 hours", delay="2 hours"):
    batches, progress = run(spark, running_features(feed.stream(), gap, delay), "update", folder)
    return [brief(batch) for batch in batches], progress


def test_a_row_between_two_sessions_joins_them(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.hours(("a", 1, 100)).hours(("a", 2, 111)).hours(("a", 4, 105)).hours(("z", 1, 130))
    feed.hours(("z", 1, 130))
    batches, _ = emitted(spark, feed, tmp_path)
    assert batches[0] == [("a", 100, 100, 1, 1, "live")]
    assert batches[1] == [("a", 111, 111, 2, 1, "live")]
    assert batches[2] == [
        ("a", 100, 111, 7, 3, "live"),
        ("a", 111, None, None, None, "absorbed"),
    ]
    rest = [row for batch in batches[3:] for row in batch]
    assert ("a", 100, 111, 7, 3, "closed") in rest
    assert sum(row[0] == "a" for row in rest) == 1


def test_an_earlier_row_moves_the_start(spark, tmp_path):
    feed = Feed(spark, tmp_path).hours(("a", 1, 100)).hours(("a", 2, 95))
    batches, _ = emitted(spark, feed, tmp_path)
    assert batches[1] == [
        ("a", 100, None, None, None, "absorbed"),
        ("a", 95, 100, 3, 2, "live"),
    ]


def test_rows_far_behind_are_kept_as_long_as_their_session_lives(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.hours(("a", 1, 5000)).hours(("a", 2, 4500), ("b", 3, 5000 - 4322.5)).hours(("c", 1, 5001))
    batches, _ = emitted(spark, feed, tmp_path, gap="180 days")
    flat = [row for batch in batches for row in batch]
    assert ("a", 4500, 5000, 3, 2, "live") in flat
    assert not any(row[0] == "b" for row in flat)  # more than 180 days and 2 hours behind


def test_late_limit_is_exact(spark, tmp_path):
    feed = Feed(spark, tmp_path).hours(("m", 1, 100))
    feed.add(("a", 5, 88 * HOUR), ("b", 7, 88 * HOUR + 1))
    batches, progress = emitted(spark, feed, tmp_path)
    assert [row[0] for row in batches[1]] == ["b"]
    assert [p.observedMetrics["late"]["sessions"] for p in progress[:2]] == [0, 1]


def test_a_late_row_that_touches_an_open_session_joins_it(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.hours(("a", 1, 90), ("m", 1, 99)).hours(("m", 1, 100)).hours(("a", 2, 82))
    batches, _ = emitted(spark, feed, tmp_path)
    assert ("a", 82, 90, 3, 2, "live") in batches[2]


def test_a_session_closes_once_gap_and_delay_have_passed(spark, tmp_path):
    feed = Feed(spark, tmp_path).hours(("a", 1, 95)).hours(("z", 1, 106)).hours(("z", 2, 106))
    feed.hours(("z", 3, 107)).hours(("z", 4, 107))
    batches, _ = emitted(spark, feed, tmp_path)
    closings = [i for i, batch in enumerate(batches) for row in batch if row[5] == "closed"]
    # At 107 h the limit is 105 h, where a's session ends; it holds from the next batch on.
    assert closings == [4]


def test_a_row_after_the_end_opens_a_new_session(spark, tmp_path):
    feed = Feed(spark, tmp_path).hours(("a", 1, 50)).hours(("z", 1, 200)).hours(("a", 2, 191))
    batches, _ = emitted(spark, feed, tmp_path)
    assert ("a", 50, 50, 1, 1, "closed") in batches[2]
    assert ("a", 191, 191, 2, 1, "live") in batches[2]


def test_only_changed_sessions_are_emitted(spark, tmp_path):
    feed = Feed(spark, tmp_path).hours(("a", 1, 1), ("b", 1, 1)).hours(("a", 1, 2))
    batches, _ = emitted(spark, feed, tmp_path)
    assert batches[1] == [("a", 1, 2, 2, 2, "live")]


def test_rows_without_views_advance_event_time(spark, tmp_path):
    feed = Feed(spark, tmp_path).hours(("a", 5, 1)).hours(("b", 0, 100)).hours(("a", 7, 2))
    batches, progress = emitted(spark, feed, tmp_path, gap="1 hour")
    marks = [p.eventTime.get("watermark") for p in progress if p.eventTime]
    assert max(marks) == "1970-01-05T02:00:00.000Z"  # 98 h
    assert batches[2] == [("a", 1, 1, 5, 1, "closed")]  # the row at 2 h was late


def test_closed_sessions_only(spark, tmp_path):
    feed = Feed(spark, tmp_path).hours(("a", 1, 50)).hours(("z", 1, 200)).hours(("z", 2, 201))
    timed = with_event_time(feed.stream(), "2 hours")
    rows = early_sessions(timed, "10 hours", early=False)
    batches, _ = run(spark, rows, "update", tmp_path)
    assert [brief(b) for b in batches if b] == [[("a", 50, 50, 1, 1, "closed")]]


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_table_whatever_the_order(spark, tmp_path, seed):
    dice = random.Random(seed)
    names = [dice.choice(["hot", f"d{i % 7}"]) for i in range(300)]
    rows = [(d, dice.randint(1, 9), dice.randint(0, 300) * HOUR // 4) for d in names]
    rows.sort(key=lambda r: r[2] + dice.randint(0, HOUR))  # out of order by up to the delay
    feed = Feed(spark, tmp_path)
    for start in range(0, 300, 60):
        feed.add(*rows[start : start + 60])
    features = running_features(feed.stream(), "2 hours", "2 hours")
    batches, _ = run(spark, features, "update", tmp_path)
    table = {}
    for batch in batches:
        for row in sorted(batch, key=lambda r: not r["absorbed"]):
            key = row["device_id"], row["session_start"]
            if row["absorbed"]:
                table.pop(key, None)
            else:
                table[key] = row
    names = "device_id first_recv_ts last_recv_ts cvt_total n_views last_view_time".split()
    found = sorted(tuple(row[n] for n in names) for row in table.values())
    assert found == sorted(plain_sessions(rows, 2 * HOUR))


def test_partial_rows_of_a_batch():
    measures = (
        *DEFAULT_MEASURES,
        Measure("low", "min", "view_time"),
        Measure("known", "count", "view_time"),
        Measure("other", "latest", "extra"),
    )
    batch = pa.RecordBatch.from_pydict(
        {
            "device_id": ["b", "a", "b", "a", None, "a"],
            "recv_timestamp": [25, -1, 20, 3, 5, 3],
            "view_time": [1, None, 4, 9, 2, 7],
            "extra": [None, 6, 8, None, None, None],
        }
    )
    out = list(partial_rows(10, "device_id", "recv_timestamp", measures)(iter([batch])))
    rows = [tuple(row.values()) for part in out for row in part.to_pylist()]
    assert len(slot_names(measures)) == len(rows[0]) - 3
    assert sorted(rows, key=repr) == sorted(
        [
            # device, first, last, total, n, (at, value), low, known, (at, value)
            ("b", 20, 25, 5, 2, 25, 1, 1, 2, 20, 8),
            ("a", -1, -1, None, 1, None, None, None, 0, -1, 6),
            ("a", 3, 3, 16, 2, 3, 9, 7, 2, None, None),
            (None, 5, 5, 2, 1, 5, 2, 2, 1, None, None),
        ],
        key=repr,
    )


def test_merging_keeps_sessions_apart():
    merged = merge_sessions([[0, 5, 1], [30, 31, 2]], [[15, 20, 4], [60, 60, 8]], 10, ["sum"])
    assert merged == [([0, 31, 7], [0, 30], True), ([60, 60, 8], [], True)]
    assert merge_sessions([[0, 5, 1]], [], 10, ["sum"]) == [([0, 5, 1], [0], False)]


class OneGroup:
    """State and timers of a group, and how often they are asked for."""

    def __init__(self):
        self.value, self.calls, self.timers = None, [], []

    def getValueState(self, name, schema):
        return self

    def registerTimer(self, at):
        self.timers.append(at)

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.calls.append("clear")
        self.value = None


def test_a_group_of_keys_is_read_and_written_once():
    state = OneGroup()
    processor = SessionProcessor(10, ["sum"], ["name", "marks", "first_ms", "last_ms", "slot_0", "status"], "x", True)
    processor.init(state)
    at = lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    large = 2**53 + 1
    names = [*(f"d{i}" for i in range(50)), None, ""]
    rows = [(0, n, "0", t, t, v) for n in names for t, v in ((0, large), (100, 0))]
    rows.append((0, "e", "1", 5, 5, 0))
    (live,) = processor.handleInputRows((0,), iter([pd.DataFrame(rows)]), at(0))
    assert state.calls == ["get", "update"] and state.timers == [10]
    found = list(live.itertuples(index=False, name=None))
    assert len(found) == 105 and sum(r[0] is None for r in found) == 2
    assert {r[4] for r in found if r[2] == 0} == {large} and ("e", "1", 5, 5, 0, "live") in found
    # Those that end leave as one table; the others have the next timer.
    (closed,) = processor.handleExpiredTimer((0,), at(15), SimpleNamespace(getExpiryTimeInMs=lambda: 10))
    assert len(closed) == 53 and set(closed["status"]) == {"closed"}
    assert len(state.value[0]) == 52 and state.timers == [10, 110]
    assert state.calls == ["get", "update"] * 2
    assert not list(processor.handleExpiredTimer((0,), at(120), SimpleNamespace(getExpiryTimeInMs=lambda: 10)))


def test_not_a_number_and_null_stay_apart(spark, tmp_path):
    rows = [(1, 1000, float("nan")), (2, 2000, None), (None, 3000, 0.5)]
    path = f"{tmp_path}/in"
    spark.createDataFrame(rows, "k long, t long, x double").write.parquet(path)
    stream = spark.readStream.schema("k long, t long, x double").parquet(path)
    timed = stream.withColumn("et", F.timestamp_millis("t")).withWatermark("et", "1 hour")
    measures = [Measure("total", "sum", "x"), Measure("last", "latest", "x")]
    rows = early_sessions(timed, "1 hour", "k", "t", measures)
    batches, _ = run(spark, rows, "update", tmp_path)
    found = {r["k"]: (repr(r["total"]), repr(r["last"])) for b in batches for r in b}
    assert found == {1: ("nan", "nan"), 2: ("None", "None"), None: ("0.5", "0.5")}
