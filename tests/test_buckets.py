"""Bucket assignment against the definition."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dwelltide.operators.buckets import assign_buckets, block_bucket, find_buckets


def plain_buckets(ids, n):
    """Contiguous blocks, larger ones first; of copies the last counts."""
    small, extra = divmod(len(ids), n)
    dealt = [b for b in range(n) for _ in range(small + (b < extra))]
    return dict(zip(ids, dealt))


def assigned(spark, ids, n):
    rows = spark.createDataFrame(list(enumerate(ids)), "pos int, id string")
    result = assign_buckets(rows, "id", n, order_by=["pos"])
    return {r[0]: r[1] for r in result.select("id", "bucket").collect()}


def test_ten_ids_in_four_buckets(spark):
    found = assigned(spark, [f"id{i}" for i in range(10)], 4)
    assert [found[f"id{i}"] for i in range(10)] == [0, 0, 0, 1, 1, 1, 2, 2, 3, 3]


def test_fewer_ids_than_buckets(spark):
    assert assigned(spark, ["x", "y"], 4) == {"x": 0, "y": 1}


def test_no_ids(spark):
    assert assigned(spark, [], 4) == {}


def test_the_last_of_copies_counts(spark):
    ids = ["a", "b", "a", "c", "d", "a", "e"]
    assert assigned(spark, ids, 3) == plain_buckets(ids, 3)


def test_copies_of_one_id_in_order_of_ids(spark):
    ids = ["a"] * 50 + ["b"] * 3 + ["c"] * 47
    rows = spark.createDataFrame([(i,) for i in ids], "id string")
    found = {r["id"]: r["bucket"] for r in assign_buckets(rows, "id", 10).collect()}
    assert found == plain_buckets(ids, 10)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 30).map(str), max_size=40), st.integers(1, 11))
def test_any_list(spark, ids, n):
    assert assigned(spark, ids, n) == plain_buckets(ids, n)


def test_closed_form_for_all_small_sizes(spark):
    cases = [(p, t, n) for n in range(1, 12) for t in range(1, 40) for p in range(t)]
    for n in range(1, 12):
        rows = spark.createDataFrame([c[:2] for c in cases if c[2] == n], "p int, t int")
        for p, t, bucket in rows.select("p", "t", block_bucket("p", "t", n)).collect():
            assert bucket == plain_buckets(list(range(t)), n)[p]


def test_unknown_ids_get_a_bucket_in_range_and_keep_it(spark):
    listed = spark.createDataFrame([(i, f"id{i}") for i in range(5)], "pos int, id string")
    wanted = spark.createDataFrame([(f"id{i}",) for i in range(3, 60)] * 2, "id string")
    known = assign_buckets(listed, "id", 4, order_by=["pos"])
    first, second = (
        {r["id"]: r["bucket"] for r in find_buckets(wanted, known, "id", 4).collect()}
        for _ in range(2)
    )
    assert first == second and len(first) == 57
    assert first["id3"] == 2 and first["id4"] == 3
    assert all(0 <= bucket < 4 for bucket in first.values())


def test_needs_a_bucket(spark):
    with pytest.raises(ValueError):
        assign_buckets(spark.createDataFrame([("a",)], "id string"), "id", 0)
