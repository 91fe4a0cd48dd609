"""One measure list, one result: fractional and whole columns, in batch and stream."""

import random

import pytest

from dwelltide.functions.measures import FRACTIONAL, WHOLE, Accumulator, Measure, typed
from dwelltide.operators.latest import latest_values
from dwelltide.operators.project import with_event_time
from dwelltide.operators.running import running_sessions
from dwelltide.operators.sessions import session_features
from dwelltide.streaming.append import closed_sessions
from dwelltide.streaming.early import early_sessions
from tests.streams import HOUR, Feed, run

SCHEMA = "device_id string, part double, small float, n int, name string, recv_timestamp bigint"
MEASURES = [
    Measure("total", "sum", "part"), Measure("low", "min", "part"), Measure("high", "max", "small"),
    Measure("newest", "latest", "part"), Measure("newest_n", "latest", "n"), Measure("n_total", "sum", "n"),
    Measure("named", "count", "name"), Measure("rows", "count"),
]
NAMES = [m.name for m in MEASURES]


def rows(seed, hours):
    rng = random.Random(seed)
    pick = lambda values: rng.choice([*values, None])
    return [
        (rng.choice("ab"), pick([1.5, -2.25, 0.5, 7.0]), pick([0.25, -1.5]), pick([1, 2**31 - 1, -5]), pick("xy"),
         int(h * HOUR) + rng.randint(0, HOUR))
        for h in hours
    ]


def found(frame):
    return sorted(
        (repr((r["device_id"], r["first_recv_ts"], r["last_recv_ts"], *(r[n] for n in NAMES))) for r in frame),
    )


def test_batch_and_streams_agree_with_a_plain_loop(spark, tmp_path):
    parts = [rows(1, range(0, 8)), rows(2, range(4, 30, 5)), rows(3, [60, 61, 64])]
    feed = Feed(spark, tmp_path, SCHEMA)
    for part in parts:
        feed.add(*part)
    table = spark.createDataFrame([r for p in parts for r in p], SCHEMA)
    expected = []
    for device in "ab":
        own = sorted((r for p in parts for r in p if r[0] == device), key=lambda r: r[5])
        sessions = []
        for r in own:
            if not sessions or r[5] - sessions[-1][-1][5] > 3 * HOUR:
                sessions.append([])
            sessions[-1].append(r)
        for s in sessions:
            of = lambda i: [r[i] for r in s if r[i] is not None]
            last = lambda i: max(((r[5], r[i]) for r in s if r[i] is not None), default=(0, None))[1]
            add = lambda v: sum(v) if v else None
            values = [add(of(1)), min(of(1), default=None), max(of(2), default=None), last(1), last(3), add(of(3)), len(of(4)), len(s)]
            expected.append({"device_id": device, "first_recv_ts": s[0][5], "last_recv_ts": s[-1][5], **dict(zip(NAMES, values))})
    batch = session_features(table, "3 hours", measures=MEASURES).collect()
    assert found(batch) == found(expected)
    timed = with_event_time(feed.stream(), "30 days")
    batches, _ = run(spark, early_sessions(timed, "3 hours", measures=MEASURES), "update", tmp_path)
    latest = {}
    for emitted in batches:
        for r in sorted(emitted, key=lambda r: not r["absorbed"]):
            latest[r["device_id"], r["session_start"]] = r
    assert found([r for r in latest.values() if not r["absorbed"]]) == found(expected)


def test_final_and_running_values_are_fractional_too(spark, tmp_path):
    feed = Feed(spark, tmp_path, SCHEMA).add(("a", 1.5, 0.5, 1, "x", 0), ("a", 2.5, 0.5, 1, "x", HOUR))
    feed.add(("z", 0.5, None, None, None, 900 * HOUR)).add(("z", 0.5, None, None, None, 901 * HOUR))
    closed = closed_sessions(with_event_time(feed.stream(), "1 hour"), "3 hours", measures=MEASURES)
    batches, _ = run(spark, closed, "append", tmp_path)
    (row,) = [r for b in batches for r in b]
    assert (row["total"], row["newest"], row["high"]) == (4.0, 2.5, 0.5)
    table = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/in/*")
    running = running_sessions(table.filter("device_id = 'a'"), "3 hours", "1 hour", measures=MEASURES)
    assert sorted((r["total"], r["newest"]) for r in running.collect()) == [(1.5, 1.5), (4.0, 2.5)]
    newest = latest_values(table, "part").filter("device_id = 'a'").first()
    assert newest["last_part"] == 2.5


def test_other_types_are_refused(spark):
    schema = spark.createDataFrame([], "a bigint, b double, c string, d decimal(10,2)").schema
    kinds = [m.type for m in typed([Measure("x", "sum", "a"), Measure("y", "max", "b"), Measure("z", "count", "c")], schema)]
    assert kinds == [WHOLE, FRACTIONAL, WHOLE]
    for column in "cd":
        with pytest.raises(ValueError, match="cannot measure"):
            typed([Measure("x", "sum", column)], schema)


def test_results_of_ones_own_in_batch_and_stream(spark, tmp_path):
    mean = Accumulator("mean", (Measure("s", "sum", "part"), Measure("n", "count", "part")), lambda s, n: s / n)
    width = Accumulator("width", (Measure("a", "max", "n"), Measure("b", "min", "n")), lambda a, b: a - b)
    measures = [mean, Measure("rows", "count"), width]
    rows = [("a", 1.5, None, 7, "x", 0), ("a", 2.5, None, 3, "x", HOUR), ("a", None, None, 5, "x", 2 * HOUR)]
    table = spark.createDataFrame(rows, SCHEMA)
    batch = session_features(table, "3 hours", measures=measures)
    assert batch.columns[-3:] == ["mean", "rows", "width"]
    assert [tuple(r)[-3:] for r in batch.collect()] == [(2.0, 3, 4)]
    running = running_sessions(table, "3 hours", "1 hour", measures=measures).collect()
    assert sorted(tuple(r)[-3:] for r in running) == [(1.5, 1, 0), (2.0, 2, 4), (2.0, 3, 4)]
    feed = Feed(spark, tmp_path, SCHEMA).add(rows[0], rows[1]).add(rows[2]).add(("z", 1.0, None, 1, "x", 99 * HOUR))
    feed.add(("z", 1.0, None, 1, "x", 100 * HOUR))
    timed = with_event_time(feed.stream(), "1 hour")
    batches, _ = run(spark, early_sessions(timed, "3 hours", measures=measures), "update", tmp_path)
    values = [(r["mean"], r["rows"], r["width"]) for b in batches for r in b if r["device_id"] == "a"]
    assert values == [(2.0, 2, 4), (2.0, 3, 4), (2.0, 3, 4)]
    closed = closed_sessions(timed, "3 hours", measures=measures)
    batches, _ = run(spark, closed, "append", tmp_path / "closed")
    assert [(r["mean"], r["rows"], r["width"]) for b in batches for r in b] == [(2.0, 3, 4)]
