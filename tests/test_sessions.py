"""Batch sessions and running values against a plain reading of the definition."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dwelltide.durations import duration_ms, interval
from dwelltide.functions.measures import Measure
from dwelltide.operators import running
from dwelltide.operators.running import running_sessions
from dwelltide.operators.sessions import session_features
from tests.plain import plain_running, plain_sessions

VIEWS = "device_id string, view_time bigint, recv_timestamp bigint"
DAY = 86_400_000


def features(spark, rows, gap, **how):
    result = session_features(spark.createDataFrame(rows, VIEWS), gap, **how)
    columns = ["device_id", "first_recv_ts", "last_recv_ts", "cvt_total", "n_views"]
    columns.append("last_view_time")
    return sorted(tuple(r) for r in result.select(*columns).collect())


def test_gap_of_exactly_the_limit_merges(spark):
    rows = [("a", 1, 0), ("a", 2, 10_000), ("a", 4, 20_001)]
    assert features(spark, rows, "10 seconds") == [
        ("a", 0, 10_000, 3, 2, 2),
        ("a", 20_001, 20_001, 4, 1, 4),
    ]


def test_half_year_gap(spark):
    rows = [("a", 1, 0), ("a", 2, 181 * DAY), ("b", 1, 0), ("b", 5, 180 * DAY)]
    assert features(spark, rows, "180 days") == [
        ("a", 0, 0, 1, 1, 1),
        ("a", 181 * DAY, 181 * DAY, 2, 1, 2),
        ("b", 0, 180 * DAY, 6, 2, 5),
    ]


def test_start_and_end_are_timestamps(spark):
    row = session_features(spark.createDataFrame([("a", 1, 1500)], VIEWS), "1 second")
    start, end = row.selectExpr("unix_millis(session_start)", "unix_millis(session_end)").head()
    assert (start, end) == (1500, 2500)


@pytest.mark.parametrize(
    ("gap", "length"), [(1, 900), (7, 900), (50, 900), (60_000, 3 * DAY), (5_000_000, 9 * DAY)]
)
def test_many_random_rows(spark, gap, length):
    dice = random.Random(gap)
    # One device has a third of the rows, and times cross zero.
    devices = [dice.choice(["hot", str(i % 40), str(i % 40)]) for i in range(3_000)]
    rows = [(d, dice.randint(0, 9), dice.randint(-length, length)) for d in devices]
    found = features(spark, [r for r in rows if r[0] is not None], gap)
    assert found == sorted(plain_sessions([r for r in rows if r[0] is not None], gap))


def test_rows_without_a_device_or_a_time(spark):
    rows = [(None, 3, 5), (None, 2, 6), ("a", 1, None), ("a", 4, 7)]
    result = session_features(spark.createDataFrame(rows, VIEWS), 10)
    found = {r["device_id"]: r["cvt_total"] for r in result.collect()}
    assert found == {None: 5, "a": 4}


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(1, 50), st.integers(0, 300)),
        min_size=1,
        max_size=40,
    ),
    st.integers(1, 40),
    st.randoms(),
)
def test_order_of_rows_does_not_matter_and_sessions_are_apart(spark, rows, gap, dice):
    found = features(spark, rows, gap)
    shuffled = list(rows)
    dice.shuffle(shuffled)
    assert features(spark, shuffled, gap) == found
    assert found == sorted(plain_sessions(rows, gap))
    for left, right in zip(found, found[1:]):
        if left[0] == right[0]:
            assert right[1] - left[2] > gap


def test_own_measures(spark):
    measures = (
        Measure("low", "min", "view_time"),
        Measure("high", "max", "view_time"),
        Measure("known", "count", "view_time"),
        Measure("newest", "latest", "view_time"),
    )
    rows = [("a", 5, 1), ("a", -2, 2), ("a", None, 3)]
    result = session_features(spark.createDataFrame(rows, VIEWS), 10, measures=measures)
    assert tuple(result.select("low", "high", "known", "newest").head()) == (-2, 5, 2, -2)


def test_sessions_across_chunk_borders(spark):
    border = 10 * DAY
    rows = [("a", 1, border - 1000 + t) for t in range(0, 2000, 10)]
    rows += [("b", 1, border - 10), ("b", 2, border), ("c", 1, border - 10), ("c", 2, border + 1)]
    rows += [("d", 1, day * DAY + t) for day in range(5) for t in range(0, DAY, 30 * 60_000)]
    for gap in (10, 30 * 60_000):
        assert features(spark, rows, gap) == sorted(plain_sessions(rows, gap))


@pytest.mark.parametrize(
    ("gap", "every"),
    [(50, 1), (50, 7), (50, 50), (100_000, 1), (1_700_000, 7_000), (7_300_000, 1000),
     (40_000_000, 9_000_000)],
)
@pytest.mark.parametrize("ticks", [None, 40, 1000])
def test_running_values(spark, monkeypatch, gap, every, ticks):
    if ticks:
        monkeypatch.setattr(running, "TICKS_PER_CHUNK", ticks)
    dice = random.Random(every)
    span = 2_000 if gap == 50 else 30_000_000
    rows = [
        (dice.choice(["hot", str(i % 5)]), dice.randint(1, 9), dice.randint(-span, span))
        for i in range(800)
    ]
    result = running_sessions(spark.createDataFrame(rows, VIEWS), gap, every)
    found = result.selectExpr(
        "device_id", "unix_millis(session_start)", "as_of_ts", "cvt_total", "n_views",
        "last_view_time",
    )
    assert sorted(tuple(r) for r in found.collect()) == sorted(plain_running(rows, gap, every))


def test_results_cannot_be_farther_apart_than_the_gap(spark):
    with pytest.raises(ValueError, match="farther apart"):
        running_sessions(spark.createDataFrame([("a", 1, 1)], VIEWS), 10, 11)


def test_durations():
    assert duration_ms("180 days") == 180 * DAY
    assert duration_ms("1 hour, 30 minutes") == 5_400_000
    assert interval("2 hours") == "7200000 milliseconds"
    for wrong in ("", "soon", "3 fortnights", 0, "0 days"):
        with pytest.raises(ValueError):
            duration_ms(wrong)


def test_sessions_inside_a_day_are_shuffled_once(spark, tmp_path):
    rows = [("a", 1, t * 60_000) for t in range(0, 5000, 7)] + [("b", 2, 86_400_000 - 5)]
    spark.createDataFrame(rows, "device_id string, view_time int, recv_timestamp bigint").write.parquet(f"{tmp_path}/v")
    table = spark.read.parquet(f"{tmp_path}/v")
    features = session_features(table, "10 minutes")
    features.collect()
    plan = features._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final or plan.count("ReusedExchange") > 0, plan
    assert sorted(r["n_views"] for r in features.collect()) == sorted(
        r["n_views"] for r in session_features(table, 600_000).collect()
    )
