"""Early results with the open sessions in a table: as the keyed ones, and what only they have."""

import random
import time

import pytest
from pyspark.sql import functions as F

from dwelltide.functions.measures import Measure, distinct_count, quantiles
from dwelltide.operators.sessions import session_features
from dwelltide.plans.device_features import JobFolders, feature_table, start_running
from dwelltide.sources.streams import FLAT_EVENT
from dwelltide.streaming.early import early_sessions
from dwelltide.operators.project import viewed, with_event_time
from dwelltide.streaming.keyed import BucketedRows
from dwelltide.streaming.open_sessions import OpenSessions, union_of
from dwelltide.streaming.sinks import decode_log, read_log
from tests.plain import plain_sessions
from tests.streams import HOUR, Feed, brief


def emitted(spark, folder, batches, gap="10 hours", delay="2 hours", again=(), **how):
    """Rows emitted per micro-batch; those of ``again`` are run twice."""
    out, schema = {}, how.pop("schema", FLAT_EVENT)
    sessions = OpenSessions(
        spark, f"{folder}/open", schema, gap, delay, lambda rows, n: out.update({n: [r.asDict() for r in rows.collect()]}),
        **{"counted": viewed(), "buckets": 3, **how},
    )
    for number, rows in enumerate(batches):
        for _ in range(1 + (number in again)):
            sessions(spark.createDataFrame(rows, schema), number)
    return [out[n] for n in sorted(out)], sessions


def hours(*rows):
    return [(d, v, int(h * HOUR)) for d, v, h in rows]


def briefly(spark, folder, batches, **how):
    found, sessions = emitted(spark, folder, [hours(*b) for b in batches], **how)
    return [brief(b) for b in found], sessions


def test_a_row_between_two_sessions_joins_them(spark, tmp_path):
    days = [[("a", 1, 100)], [("a", 2, 111)], [("a", 4, 105)], [("z", 1, 130)], []]
    batches, _ = briefly(spark, tmp_path, days, again=(1, 2, 3))
    assert batches[0] == [("a", 100, 100, 1, 1, "live")]
    assert batches[1] == [("a", 111, 111, 2, 1, "live")]
    assert batches[2] == [("a", 100, 111, 7, 3, "live"), ("a", 111, None, None, None, "absorbed")]
    assert batches[3] == [("a", 100, 111, 7, 3, "closed"), ("z", 130, 130, 1, 1, "live")]
    assert batches[4] == []


def test_an_earlier_row_moves_the_start(spark, tmp_path):
    batches, _ = briefly(spark, tmp_path, [[("a", 1, 100)], [("a", 2, 95)]])
    assert batches[1] == [("a", 100, None, None, None, "absorbed"), ("a", 95, 100, 3, 2, "live")]


def test_rows_far_behind_are_kept_as_long_as_their_session_lives(spark, tmp_path):
    days = [[("a", 1, 5000)], [("a", 2, 4500), ("b", 3, 5000 - 4322.5)], [("c", 1, 5001)]]
    batches, sessions = briefly(spark, tmp_path, days, gap="180 days")
    flat = [row for batch in batches for row in batch]
    assert ("a", 4500, 5000, 3, 2, "live") in flat and not any(row[0] == "b" for row in flat)
    assert sessions.late == 1


def test_late_limit_is_exact(spark, tmp_path):
    batches, sessions = emitted(spark, tmp_path, [hours(("m", 1, 100)), [("a", 5, 88 * HOUR), ("b", 7, 88 * HOUR + 1)]])
    assert [row["device_id"] for row in batches[1]] == ["b"] and sessions.late == 1


def test_a_late_row_that_touches_an_open_session_joins_it(spark, tmp_path):
    batches, _ = briefly(spark, tmp_path, [[("a", 1, 90), ("m", 1, 99)], [("m", 1, 100)], [("a", 2, 82)]])
    assert ("a", 82, 90, 3, 2, "live") in batches[2]


def test_a_session_closes_once_gap_and_delay_have_passed(spark, tmp_path):
    days = [[("a", 1, 95)], [("z", 1, 106)], [("z", 2, 107 - 1 / HOUR)], [("z", 3, 107)], [("z", 4, 107)]]
    batches, _ = briefly(spark, tmp_path, days)
    assert [i for i, batch in enumerate(batches) for row in batch if row[5] == "closed"] == [3]


def test_only_changed_sessions_are_emitted(spark, tmp_path):
    batches, _ = briefly(spark, tmp_path, [[("a", 1, 1), ("b", 1, 1), (None, 1, 1)], [("a", 1, 2)], [(None, 1, 3)]])
    assert batches[1] == [("a", 1, 2, 2, 2, "live")] and batches[2] == [(None, 1, 3, 2, 2, "live")]


def test_rows_without_views_advance_event_time(spark, tmp_path):
    batches, _ = briefly(spark, tmp_path, [[("a", 5, 1)], [("b", 0, 100)], [("a", 7, 2)]], gap="1 hour")
    assert batches[1] == [("a", 1, 1, 5, 1, "closed")] and batches[2] == []


def test_firing_by_the_clock_emits_open_sessions_without_input(spark, tmp_path):
    times = iter([0, 1_000, 4_000, 5_000, 9_000])
    days = [[("a", 1, 1), ("b", 1, 1)], [("a", 1, 2)], [], [], [("b", 2, 2)]]
    batches, _ = briefly(spark, tmp_path, days, fire_every="4 seconds", clock=lambda: next(times))
    both = [("a", 1, 2, 2, 2, "live"), ("b", 1, 1, 1, 1, "live")]
    assert batches[1] == both[:1] and batches[2] == both and batches[3] == []
    assert batches[4] == [both[0], ("b", 1, 2, 3, 2, "live")]


def test_a_silent_source_stops_holding_event_time_back(spark, tmp_path):
    def rows(*given):
        return [(d, v, int(h * HOUR), s) for d, v, h, s in given]

    times = iter(range(0, 1_000_000, 25_000))
    days = [
        rows(("a", 1, 1, "x"), ("b", 1, 1, "y")), rows(("c", 1, 50, "x")), rows(("c", 1, 51, "x")), rows(("c", 1, 52, "x")),
        rows(("d", 1, 30, "y")), rows(("c", 1, 53, "x")),
    ]
    how = {"source": "source", "sources": ("x", "y"), "clock": lambda: next(times), "schema": f"{FLAT_EVENT}, source string"}
    batches, sessions = emitted(spark, tmp_path, days, **how)
    found = [brief(b) for b in batches]
    # Silent for a minute in the fourth: what it held back closes.
    assert [sum(row[5] == "closed" for row in b) for b in found] == [0, 0, 0, 2, 0, 0]
    # Awake again it is behind the limit, which does not fall; its rows are late by it.
    assert found[4] == [] and sessions.late == 1


def test_a_source_never_heard_of_holds_back_for_as_long(spark, tmp_path):
    times = iter(range(0, 1_000_000, 40_000))
    days = [[("a", 1, h * HOUR, "x")] for h in (1, 100, 101)]
    how = {"source": "source", "sources": ("x", "y"), "clock": lambda: next(times), "schema": f"{FLAT_EVENT}, source string"}
    batches, _ = emitted(spark, tmp_path, days, **how)
    assert [sum(r["closed"] for r in b) for b in batches] == [0, 0, 1]
    with pytest.raises(ValueError, match="name the sources"):
        OpenSessions(spark, str(tmp_path), FLAT_EVENT, 1, 1, source="source")


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_table_whatever_the_order(spark, tmp_path, seed):
    dice = random.Random(seed)
    names = [dice.choice(["hot", f"d{i % 7}"]) for i in range(300)]
    rows = [(d, dice.randint(1, 9), dice.randint(0, 300) * HOUR // 4) for d in names]
    rows.sort(key=lambda r: r[2] + dice.randint(0, HOUR))
    feed = Feed(spark, tmp_path)
    for start in range(0, 300, 60):
        feed.add(*rows[start : start + 60])
    folders = JobFolders(str(tmp_path), "job")
    start_running(
        spark, feed.stream(), folders, "2 hours", "2 hours", buckets=3, state="table", trigger={"availableNow": True}
    ).awaitTermination()
    schema = session_features(feed_table(feed), "2 hours").schema
    table = feature_table(schema.add("closed", "boolean").add("absorbed", "boolean"), folders.table, 3).latest(spark)
    names = "device_id first_recv_ts last_recv_ts cvt_total n_views last_view_time".split()
    assert sorted(map(tuple, table.select(*names).collect())) == sorted(plain_sessions(rows, 2 * HOUR))
    log = decode_log(read_log(spark, folders.log), schema).filter("closed")
    assert log.count() == log.select("device_id", "session_start").distinct().count() > 0


def feed_table(feed):
    return feed.spark.read.schema(FLAT_EVENT).parquet(f"{feed.folder}/in/*")


def test_sketches_merge_alike_in_batch_and_stream(spark, tmp_path):
    schema = "device_id string, kind string, size int, recv_timestamp bigint"
    dice = random.Random(7)
    rows = [(dice.choice("ab"), f"k{dice.randrange(3000)}", dice.randrange(10_000), i * HOUR // 900) for i in range(9000)]
    measures = [distinct_count("kinds", "kind"), quantiles("sizes", "size", (0.5, 0.9)), Measure("n", "count")]
    batch = {r["device_id"]: r for r in session_features(spark.createDataFrame(rows, schema), "6 hours", measures=measures).collect()}
    days = [rows[i : i + 1500] for i in range(0, 9000, 1500)]
    batches, _ = emitted(spark, tmp_path, days, "6 hours", measures=measures, counted=None, schema=schema)
    for device in "ab":
        kinds = len({r[1] for r in rows if r[0] == device})
        sizes = sorted(r[2] for r in rows if r[0] == device)
        last = [r for r in batches[-1] if r["device_id"] == device][-1]
        for found in (batch[device], last):
            assert found["n"] == len(sizes) and abs(found["kinds"] / kinds - 1) < 3 * 0.016
            for rank, value in zip((0.5, 0.9), found["sizes"]):
                assert abs(sum(s <= value for s in sizes) / len(sizes) - rank) < 0.04
        assert batch[device]["kinds"] == last["kinds"]
    feed = Feed(spark, tmp_path, schema).add(("a", "x", 1, 1))
    with pytest.raises(ValueError, match="keep open sessions in a table"):
        early_sessions(with_event_time(feed.stream(), "1 hour"), "1 hour", measures=measures)


def test_open_sessions_fire_again_in_a_running_job(spark, tmp_path):
    feed = Feed(spark, tmp_path).hours(("a", 1, 1), ("b", 2, 1))
    folders = JobFolders(str(tmp_path), "job")
    how = {"buckets": 2, "state": "table", "fire_every": "2 seconds"}
    for wrong in ({"trigger": {"availableNow": True}}, {"state": "keyed"}):
        with pytest.raises(ValueError):
            start_running(spark, feed.stream(), folders, "10 hours", **{**how, **wrong})
    query = start_running(spark, feed.stream(), folders, "10 hours", trigger={"processingTime": "1 second"}, **how)
    deadline, seen = time.time() + 90, 0
    while seen < 3 and time.time() < deadline and query.isActive:
        time.sleep(1)
        try:
            seen = read_log(spark, folders.log).filter(F.col("partition_key").isNotNull()).select("batch_id").distinct().count()
        except Exception:  # the log is being written
            continue
    query.stop()
    assert query.exception() is None and seen >= 3


def test_a_union_names_its_sources(spark, tmp_path):
    one = spark.createDataFrame([("a", 1, 1)], FLAT_EVENT)
    assert sorted(r["source"] for r in union_of({"x": one, "y": one}).collect()) == ["x", "y"]


def test_buckets_are_replaced_in_turn(spark, tmp_path):
    held = BucketedRows(f"{tmp_path}/b", "k string, v int", "k", 4)
    everything = lambda: sorted(map(tuple, held.read(spark, held.state(spark)).collect()))
    assert everything() == []
    frame = lambda *rows: spark.createDataFrame(list(rows), "k string, v int")
    first = [("a", 3), ("b", 5), ("c", 7)]
    state = held.replace(spark, held.state(spark), [0, 1, 2, 3], frame(*first), 0, "mark")
    assert everything() == first and held.state(spark) == state
    bucket = {r["k"]: r["b"] for r in frame(*first).select("k", held.bucket(F.col("k")).alias("b")).collect()}
    for _ in range(2):  # the second run finds what the first one found
        before = held.state(spark, before=1)
        assert before == state
        same = [(k, v) for k, v in first if bucket[k] == bucket["a"] and k != "a"]
        new = held.replace(spark, before, [bucket["a"]], frame(("a", 30), *same), 1, least={bucket["a"]: 30})
        assert everything() == [("a", 30), *first[1:]]
    assert held.state(spark).least[bucket["a"]] == 30 and new == held.state(spark)
    held.replace(spark, held.state(spark, before=2), sorted(set(bucket.values())), frame(), 2)
    assert everything() == [] and held.state(spark, before=2).number == 1
