"""Projection, filter, latency, latest values."""

from pyspark.sql import functions as F

from dwelltide.functions.clock import lag_seconds
from dwelltide.operators.latency import latency_histogram
from dwelltide.operators.latest import latest_values, newest_per_key
from dwelltide.operators.project import client_versions, device_input, view_input
from dwelltide.sources.streams import FLAT_EVENT


def test_only_positive_view_times_remain(spark):
    rows = [("a", None, 1), ("a", 0, 2), ("a", -3, 3), ("a", 5, 4)]
    events = spark.createDataFrame(rows, FLAT_EVENT)
    assert [tuple(r) for r in view_input(events).collect()] == [("a", 5, 4)]


def test_missing_view_time_is_zero_and_long(spark):
    events = spark.createDataFrame([("a", None, 1), ("b", 7, 2)], FLAT_EVENT)
    result = device_input(events)
    assert dict(result.dtypes)["view_time"] == "bigint"
    assert sorted(tuple(r) for r in result.collect()) == [("a", 0, 1), ("b", 7, 2)]


def test_lag_truncates_toward_zero(spark):
    clock = 1_000_000
    rows = spark.createDataFrame([(clock + 1500,), (clock - 1500,), (clock,)], "t bigint")
    lags = [r[0] for r in rows.select(lag_seconds("t", clock)).collect()]
    assert lags == [-1, 1, 0]


def test_lag_by_the_query_clock(spark):
    rows = spark.range(1).select(F.unix_millis(F.current_timestamp()).alias("t"))
    assert abs(rows.select(lag_seconds("t")).head()[0]) <= 1


def test_latency_histogram_buckets_truncate(spark):
    rows = spark.createDataFrame([(-15_000,), (0,), (9_000,), (25_000,)], "recv_timestamp bigint")
    result = latency_histogram(rows, 0, 10)
    assert sorted(tuple(r) for r in result.collect()) == [(-20, 1), (0, 2), (10, 1)]


def test_two_columns_of_the_log(spark):
    logs = spark.createDataFrame([("tv", "1.2", 3)], "platform string, version string, x int")
    assert [tuple(r) for r in client_versions(logs).collect()] == [("tv", "1.2")]


def test_latest_value_breaks_ties_by_value(spark):
    rows = spark.createDataFrame(
        [("a", 9, 1), ("a", 2, 5), ("a", 4, 5), ("b", -1, -7), ("b", None, 3)],
        "device_id string, view_time bigint, recv_timestamp bigint",
    )
    result = latest_values(rows, "view_time")
    assert sorted(tuple(r) for r in result.collect()) == [("a", 5, 4), ("b", 3, -1)]


def test_latest_value_at_the_ends_of_long(spark):
    values = [-(2**63), 2**63 - 1, 0, -1]
    rows = spark.createDataFrame(
        [(str(i), v, t) for i, v in enumerate(values) for t in (-5,)],
        "device_id string, view_time bigint, recv_timestamp bigint",
    )
    result = {r[0]: r[2] for r in latest_values(rows, "view_time").collect()}
    assert result == {str(i): v for i, v in enumerate(values)}


def test_newest_row_per_key(spark):
    rows = spark.createDataFrame(
        [(1, 1, "x"), (1, 3, "y"), (1, 2, "z"), (2, 1, None)], "k int, t int, v string"
    )
    result = newest_per_key(rows, ["k"], ["t"])
    assert sorted(tuple(r) for r in result.collect()) == [(1, 3, "y"), (2, 1, None)]
