"""Whole jobs: append mode, sinks, replay, restart, metrics, printing."""

import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from dwelltide.functions.payload import MAX_RECORD_BYTES
from dwelltide.operators.project import with_event_time
from dwelltide.plans.device_features import (
    JobFolders,
    device_features,
    feature_table,
    final_features,
    running_features,
    start_final,
    start_running,
)
from dwelltide.plans.printing import await_any, start_client_and_event_print, start_text_print
from dwelltide.session import settings
from dwelltide.sources.streams import CLIENT_LOG, FLAT_EVENT, Stream
from dwelltide.streaming.append import closed_sessions
from dwelltide.streaming.metrics import MetricsTable, observe_latency, report_metrics
from dwelltide.streaming.runs import RUN_SPAN, batch_number, run_of
from dwelltide.streaming.sinks import (
    FeatureSinks,
    FeatureTable,
    decode_log,
    put_batches,
    read_log,
    write_log_batch,
)
from tests.streams import HOUR, Feed, run

NOW = {"availableNow": True}
FEATURES = "device_id first_recv_ts last_recv_ts cvt_total n_views last_view_time".split()


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def job(spark, feed, folders, gap="10 hours", **how):
    query = start_running(
        spark, feed.stream(), folders, gap, "1 day", **{"buckets": 3, "trigger": NOW, **how}
    )
    query.awaitTermination()
    return feature_table(running_features(feed.stream(), gap), folders.table, how.get("buckets", 3))


def history(feed):
    feed.hours(("a", 1, 1), ("b", 2, 1)).hours(("a", 3, 20), ("b", 0, 21))
    return feed.hours(("a", 4, 10.5), ("c", 5, 30))


def test_final_sessions_and_the_late_limit(spark, tmp_path):
    # Spark's own operators apply a new limit to late rows one micro-batch after it is known.
    feed = Feed(spark, tmp_path).hours(("m", 1, 100)).hours(("m", 1, 100))
    feed.add(("a", 5, 88 * HOUR), ("b", 7, 88 * HOUR + 1)).hours(("m", 1, 150))
    features = final_features(feed.stream(), "10 hours", "2 hours")
    batches, progress = run(spark, features, "append", tmp_path)
    assert sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators) == 1
    found = [(r["device_id"], r["cvt_total"]) for batch in batches for r in batch]
    assert sorted(found) == [("b", 7), ("m", 2)]


def test_final_sessions_drop_a_late_row_that_touches_an_open_one(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.hours(("a", 3, 90), ("m", 1, 100)).hours(("m", 1, 100)).hours(("a", 2, 82))
    feed.hours(("m", 1, 150)).hours(("m", 1, 151))
    timed = with_event_time(feed.stream(), "2 hours")
    batches, _ = run(spark, closed_sessions(timed, "10 hours"), "append", tmp_path)
    found = [(r["first_recv_ts"] / HOUR, r["cvt_total"]) for b in batches for r in b
             if r["device_id"] == "a"]
    assert found == [(90, 3)]


def test_rows_without_views_advance_event_time_of_the_final_job(spark, tmp_path):
    feed = Feed(spark, tmp_path).hours(("a", 5, 1)).hours(("b", 0, 100)).hours(("b", 0, 100))
    feed.hours(("a", 7, 2))
    features = final_features(feed.stream(), "1 hour", "2 hours")
    _, progress = run(spark, features, "append", tmp_path)
    assert sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators) == 1


def test_table_log_and_batch_agree(spark, tmp_path):
    feed = history(Feed(spark, tmp_path))
    folders = JobFolders(str(tmp_path), "job")
    table = job(spark, feed, folders)
    events = spark.read.parquet(f"{tmp_path}/in/*")
    expected = rows_of(device_features(events, "10 hours"), *FEATURES)
    assert rows_of(table.latest(spark), *FEATURES) == expected

    log = decode_log(read_log(spark, folders.log), running_features(feed.stream()).schema)
    newest = {}
    for row in sorted(log.collect(), key=lambda r: (r["batch_id"], not r["absorbed"])):
        newest[row["device_id"], row["session_start"]] = row
    alive = [tuple(r[c] for c in FEATURES) for r in newest.values() if not r["absorbed"]]
    assert sorted(alive, key=repr) == expected
    keys = read_log(spark, folders.log).select("partition_key").distinct().count()
    assert keys == 3  # one per device, by key_columns


def test_running_a_batch_again_changes_nothing(spark, tmp_path):
    feed = history(Feed(spark, tmp_path))
    folders = JobFolders(str(tmp_path), "job")
    table = job(spark, feed, folders)
    before = rows_of(table.latest(spark), "*"), rows_of(read_log(spark, folders.log), "*")
    newest = table._rows.state(spark).number
    run, batch_id = divmod(newest, RUN_SPAN)
    written = decode_log(read_log(spark, folders.log).filter(F.col("batch_id") == newest), table.schema).drop("batch_id")
    again = spark.createDataFrame(written.collect(), table.schema)
    sinks = FeatureSinks(table, Stream(folders.log, key_columns=["device_id"]).sink(run=run), run)
    for _ in range(2):
        sinks(again, batch_id)
    with pytest.raises(ValueError, match="is past micro-batch"):
        table.write_batch(again, newest - 1)
    assert (rows_of(table.latest(spark), "*"), rows_of(read_log(spark, folders.log), "*")) == before


def test_a_batch_of_the_log_has_no_more_files_than_writers(spark, tmp_path):
    rows = spark.createDataFrame([(f"d{i}", i) for i in range(40)], "d string, n int").repartition(8)
    write_log_batch(rows, 0, f"{tmp_path}/log", ["d"], writers=2)
    assert len(list(tmp_path.glob("log/batch_id=0/oversized=false/*.parquet"))) == 2


@pytest.mark.parametrize("state", ["keyed", "table"])
def test_restart_from_the_checkpoint(spark, tmp_path, state):
    whole = history(Feed(spark, tmp_path / "whole"))
    expected = job(spark, whole, JobFolders(str(tmp_path), "whole"))
    parts = Feed(spark, tmp_path / "parts")
    folders = JobFolders(str(tmp_path), "parts")
    parts.hours(("a", 1, 1), ("b", 2, 1))
    job(spark, parts, folders, state=state)
    parts.hours(("a", 3, 20), ("b", 0, 21))
    job(spark, parts, folders, state=state)
    parts.hours(("a", 4, 10.5), ("c", 5, 30))
    table = job(spark, parts, folders, state=state)
    assert rows_of(table.latest(spark), *FEATURES) == rows_of(expected.latest(spark), *FEATURES)


def test_restart_of_the_final_job(spark, tmp_path):
    feed = Feed(spark, tmp_path).hours(("a", 1, 1))
    folders = JobFolders(str(tmp_path), "final")
    for rows in ([("a", 2, 5), ("m", 1, 50)], [("m", 1, 100)]):
        feed.hours(*rows)
        query = start_final(
            spark, feed.stream(), folders, "10 hours", "2 hours", writers=2, trigger=NOW
        )
        query.awaitTermination()
    schema = final_features(feed.stream()).schema
    log = decode_log(read_log(spark, folders.final.log), schema)
    assert rows_of(log, "device_id", "cvt_total") == [("a", 3), ("m", 1)]


def test_oversized_records_go_to_quarantine(spark, tmp_path):
    overhead = len('{"s":""}')
    sizes = [MAX_RECORD_BYTES - overhead, MAX_RECORD_BYTES - overhead + 1]
    rows = spark.createDataFrame([(n,) for n in sizes], "n int")
    write_log_batch(rows.select(F.expr("repeat('x', n)").alias("s")), 0, f"{tmp_path}/log")
    lengths = F.octet_length("payload")
    assert rows_of(read_log(spark, f"{tmp_path}/log"), lengths) == [(MAX_RECORD_BYTES,)]
    assert rows_of(read_log(spark, f"{tmp_path}/log", oversized=True), lengths) == [
        (MAX_RECORD_BYTES + 1,)
    ]


SMALL = "k string, v int, t int, gone boolean"


def test_feature_table(spark, tmp_path):
    table = FeatureTable(f"{tmp_path}/t", SMALL, ["k"], ["t"], "gone", buckets=2)
    assert table.latest(spark).collect() == [] and table.lookup(spark, "a").collect() == []

    def write(batch_id, *rows):
        table.write_batch(spark.createDataFrame(list(rows), SMALL), batch_id)

    first = ("a", 1, 1, False), ("b", 1, 1, False), ("b", 2, 2, False), (None, 9, 1, False)
    second = ("a", None, 1, True), ("c", 3, 1, None)
    write(0, *first)
    write(1, *second)
    expected = sorted([("b", 2, 2), ("c", 3, 1), (None, 9, 1)], key=repr)
    assert rows_of(table.latest(spark), "*") == expected
    write(1, *second)
    assert rows_of(table.latest(spark), "*") == expected
    write(2, ("a", 7, 3, False), ("c", 0, 2, True), (None, 10, 2, False))
    expected = sorted([("a", 7, 3), ("b", 2, 2), (None, 10, 2)], key=repr)
    assert rows_of(table.latest(spark), "*") == expected
    for value in ("a", "b", "c", None, "absent"):
        assert rows_of(table.lookup(spark, value), "*") == [r for r in expected if r[0] == value]
    assert rows_of(table.lookup(spark, "a", "b"), "k") == [("a",), ("b",)]
    write(3, ("a", 0, 9, True), ("b", 0, 9, True), (None, 0, 9, True))
    assert table.latest(spark).collect() == []
    write(4)
    write(5, ("z", 1, 1, False))
    assert rows_of(table.latest(spark), "*") == [("z", 1, 1)]


def test_a_new_checkpoint_replaces_and_hides_nothing(spark, tmp_path):
    feed = history(Feed(spark, tmp_path / "one"))
    folders = JobFolders(str(tmp_path), "job")
    table = job(spark, feed, folders)
    before, log = rows_of(table.latest(spark), *FEATURES), rows_of(read_log(spark, folders.log), "*")
    (tmp_path / "job/checkpoint").rename(tmp_path / "old_checkpoint")
    more = Feed(spark, tmp_path / "two").hours(("x", 1, 900)).hours(("y", 2, 901), ("a", 9, 950))
    table = job(spark, more, folders)
    after = rows_of(table.latest(spark), *FEATURES)
    assert set(before) < set(after) and {r[0] for r in set(after) - set(before)} == {"x", "y", "a"}
    assert set(log) < set(rows_of(read_log(spark, folders.log), "*"))


def test_a_checkpoint_keeps_its_run_and_kind(spark, tmp_path):
    runs = [run_of(spark, f"{tmp_path}/c{i}", "x") for i in (0, 1, 0, 2)]
    assert runs[0] == runs[2] < runs[1] < runs[3]
    with pytest.raises(ValueError, match="another job: x"):
        run_of(spark, f"{tmp_path}/c1", "y")
    assert batch_number(2, 5) == 2 * RUN_SPAN + 5


def test_early_and_final_results_have_folders_of_their_own(spark, tmp_path):
    feed = Feed(spark, tmp_path).hours(("a", 1, 1)).hours(("b", 1, 100)).hours(("b", 1, 101))
    folders = JobFolders(str(tmp_path), "job")
    for start in (start_running, start_final):
        start(spark, feed.stream(), folders, "10 hours", "2 hours", trigger=NOW).awaitTermination()
    assert read_log(spark, folders.log).count() == 4
    assert read_log(spark, folders.final.log).count() == 1
    assert folders.final.checkpoint != folders.checkpoint


def test_what_cannot_be_decoded_is_kept(spark, tmp_path):
    texts = ['{"device_id":"a","view_time":1,"recv_timestamp":5}', "broken", '{"device_id":"b","view_time":2,"recv_timestamp":6}{"x":1}', ""]
    spark.createDataFrame([(t.encode(),) for t in texts], "value binary").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = Stream(f"{tmp_path}/in", "device_id string, view_time int, recv_timestamp bigint", decoder="json")
    for start, folders in ((start_running, JobFolders(str(tmp_path), "j")), (start_final, JobFolders(str(tmp_path), "j"))):
        start(spark, stream.source(spark, quarantine=True), folders, trigger=NOW).awaitTermination()
        kept = folders.quarantine if start is start_running else folders.final.quarantine
        assert rows_of(spark.read.parquet(kept), "malformed_payload") == rows_of(spark.createDataFrame([(t,) for t in texts if t != texts[0]], "t string"), "t")
    table = feature_table(running_features(stream.source(spark, quarantine=True).drop("malformed_payload")), f"{tmp_path}/j/table")
    assert rows_of(table.latest(spark), "device_id", "cvt_total") == [("a", 1)]


@pytest.mark.parametrize("records,size", [(500, 5 << 20), (7, 100), (3, 40), (1, 1)])
def test_records_are_put_in_batches(spark, records, size):
    dice = random.Random(records)
    lengths = [dice.choice([0, 1, 5, 30, 60, 150, None]) for _ in range(400)]
    rows = spark.createDataFrame([(i, None if n is None else b"x" * n) for i, n in enumerate(lengths)], "i int, p binary")
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "23"}):
        found = put_batches(rows.repartition(3), "p", records, size).collect()
    assert [r["i"] for r in sorted(found)] == list(range(400))
    for writer in {r["writer"] for r in found}:
        own, put, held, total = [r for r in found if r["writer"] == writer], 0, 0, 0
        for r in own:
            n = len(r["p"] or b"")
            if held and (held == records or total + n > size):
                put, held, total = put + 1, 0, 0
            held, total = held + 1, total + n
            assert r["put"] == put
    with pytest.raises(ValueError):
        put_batches(rows, "p", 0)


def test_metrics(spark, tmp_path):
    feed = history(Feed(spark, tmp_path))
    reports = []
    table = MetricsTable(spark, f"{tmp_path}/metrics", every=2)
    listener = report_metrics(spark, lambda report: (table(report), reports.append(report)))
    try:
        job(spark, feed, JobFolders(str(tmp_path), "measured"))
        deadline = time.time() + 30
        while sum(r["input_rows"] for r in reports) < 6 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    first = next(r for r in reports if r["batch_id"] == 0)
    assert first["query"] == "measured"
    assert first["latency"]["n"] == 2 and first["latency"]["min_s"] > 0
    assert first["emitted"]["n"] == 2
    second = next(r for r in reports if r["batch_id"] == 1)
    # The row without views is read, but neither measured nor emitted.
    assert second["input_rows"] == 2 and second["latency"]["n"] == 1
    assert sum(s["rows"] for s in second["state"]) > 0

    table.flush()
    kept = spark.read.parquet(f"{tmp_path}/metrics")
    assert rows_of(kept.filter("input_rows > 0"), "batch_id", "input_rows") == [
        (0, 2), (1, 2), (2, 2),
    ]
    seen = kept.filter("batch_id = 0").selectExpr("get_json_object(metrics['latency'], '$.n')")
    assert seen.head()[0] == "2"


def test_an_idle_source_does_not_hold_back_event_time(spark, tmp_path):
    busy = Feed(spark, tmp_path / "busy").hours(("a", 1, 1)).hours(("b", 1, 100)).hours(("c", 1, 3))
    idle = Feed(spark, tmp_path / "idle").hours(("z", 1, 0))
    both = busy.stream().unionByName(idle.stream())
    features = running_features(both, "1 hour", "2 hours")
    _, progress = run(spark, features, "update", tmp_path)
    marks = [p.eventTime["watermark"] for p in progress if p.eventTime]
    assert max(marks) == "1970-01-05T02:00:00.000Z"


def test_latency_metric_of_a_table(spark):
    from pyspark.sql import Observation

    rows = spark.createDataFrame([(0,), (4_000,), (9_500,)], "recv_timestamp bigint")
    metric = Observation("lag")
    assert observe_latency(rows, metric, now_ms=10_000).count() == 3
    found = metric.get
    assert (found["n"], found["min_s"], found["max_s"], found["le_1_s"], found["le_30_s"]) == (
        3, 0, 10, 1, 3,
    )


def test_two_printing_streams(spark, tmp_path):
    logs = Feed(spark, tmp_path / "logs", CLIENT_LOG).add(("tv", "1"), ("web", "2"))
    events = Feed(spark, tmp_path / "events", FLAT_EVENT).add(("d", 0, 5))
    folder = str(tmp_path)
    for query in start_client_and_event_print(
        logs.stream(), events.stream(), folder=folder, trigger=NOW
    ):
        query.awaitTermination()
    versions = spark.read.parquet(f"{folder}/client_versions")
    assert rows_of(versions, "*") == [("tv", "1"), ("web", "2")]
    assert rows_of(spark.read.parquet(f"{folder}/raw_events"), "value") == [
        ('{"deviceId":"d","recvTimestamp":"5"}',)
    ]


def test_printing_to_the_console(spark, tmp_path):
    lines = Feed(spark, tmp_path, "value string").add(("hello stream",))
    query = start_text_print(lines.stream(), trigger=NOW)
    query.awaitTermination()
    assert query.exception() is None
    assert "Console" in query.lastProgress.sink.description


def test_a_job_waits_for_its_queries(spark, tmp_path):
    lines = Feed(spark, tmp_path, "value string").add(("x",))
    query = start_text_print(lines.stream(), folder=str(tmp_path))
    spark.streams.resetTerminated()
    threading.Timer(3, query.stop).start()
    await_any(spark, 60)
    assert not query.isActive


def test_a_time_and_a_key_of_ones_own(spark, tmp_path):
    rows = [("a", 1, 1), ("a", 2, 3)]
    feed = Feed(spark, tmp_path, "device_id string, view_time int, seen_s long").add(*rows)
    own_time = {"event_ms": F.col("seen_s") * 1000, "key": lambda names: F.concat(F.lit("k-"), names[0])}
    folders = JobFolders(str(tmp_path), "job")
    query = start_running(spark, feed.stream(), folders, "10 hours", trigger=NOW, **own_time)
    query.awaitTermination()
    features = running_features(feed.stream(), "10 hours", event_ms=F.col("seen_s") * 1000)
    table = feature_table(features, folders.table)
    assert rows_of(table.latest(spark), "device_id", "first_recv_ts", "last_recv_ts") == [("a", 1000, 3000)]
    assert rows_of(read_log(spark, folders.log), "partition_key") == [("k-a",)]
