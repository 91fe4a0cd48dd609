"""Nearest neighbours and top scores against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dwelltide.llm import top_scores as T
from dwelltide.llm.blocks import Heaps
from dwelltide.llm.neighbours import _products, _Rounded, nearest_neighbours
from dwelltide.llm.top_scores import top_scores

SCHEMA = "vec_id long, embedding array<float>, score string, rank string"


def good(vector, zero):
    return (
        vector is not None
        and len(vector) > 0
        and all(x is not None and math.isfinite(x) for x in vector)
        and (zero or any(vector))
    )


def plain(rows, every, k, measure, zero):
    rows = [(i, v) for i, v in rows if i is not None and good(v, zero)]
    found = []
    for qid, q in rows:
        if qid % every:
            continue
        scored = [(measure(q, c), cid) for cid, c in rows if cid != qid and len(c) == len(q)]
        best = sorted(scored, key=lambda s: (-s[0], s[1]))[:k]
        found += [(qid, n + 1, cid, s) for n, (s, cid) in enumerate(best)]
    return sorted(found)


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += float(np.float32(x)) * float(np.float32(y))
    return total


def whole_dot(a, b):
    return sum(math.floor(256 * float(np.float32(x))) * math.floor(256 * float(np.float32(y))) for x, y in zip(a, b))


def rows_of(seed, n=400, width=12):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, width)).astype(np.float32)
    vectors[n // 2 : n // 2 + 60] = vectors[n // 2]  # a group of copies: ties
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    nan = float("nan")
    rows += [
        (n, None), (n + 20, [0.0] * width), (n + 40, [nan] * width), (n + 60, [None] * width),
        (n + 61, [1.0] * (width - 1)), (n + 80, [2.0] * (width - 1)), (n + 100, []), (None, [1.0] * width),
        (n + 62, [float("inf")] + [0.0] * (width - 1)), (3, rows[3][1]),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(3)


def test_neighbours_are_those_of_all_pairs(spark):
    rows = rows_of(1)
    found = nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0, k=7).collect()
    assert sorted(map(tuple, found)) == plain(rows, 20, 7, dot, zero=False)


def test_scores_are_those_of_all_pairs(spark):
    rows = rows_of(2)
    found = top_scores(frame(spark, rows), F.col("vec_id") % 20 == 0, k=5).collect()
    assert sorted(map(tuple, found)) == plain(rows, 20, 5, whole_dot, zero=True)


@pytest.mark.parametrize("search", [nearest_neighbours, top_scores])
def test_few_and_no_rows(spark, search):
    few = frame(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [0.5, 0.5])])
    assert search(few, F.col("vec_id") % 20 == 0).count() == 4
    assert search(few.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_a_query_id_on_two_rows_asks_once(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0])]
    found = nearest_neighbours(frame(spark, rows), F.col("vec_id") == 0, k=5).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"])] == [(2, 2.0), (1, 0.0)]


def test_scores_beyond_a_double_and_a_long(spark):
    big = 3e18
    rows = [(0, [big, 1.0]), (1, [big, 0.0]), (2, [-big, 0.0])]
    found = top_scores(frame(spark, rows), F.col("vec_id") == 0, k=2).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in found) == [
        (1, 1, (1 << 63) - 1), (2, 2, -(1 << 63)),
    ]
    wide = spark.createDataFrame([(0, [1e200]), (1, [1e200]), (2, [1.0])], "vec_id long, embedding array<double>")
    found = nearest_neighbours(wide, F.col("vec_id") == 0, k=2).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in found) == [(1, 1), (2, 2)]


def test_bounds_hold():
    rng = np.random.default_rng(3)
    for spread in (1e-30, 1.0, 1e6):
        a, b = rng.normal(size=(50, 33)) * spread, rng.standard_cauchy(size=(60, 33))
        near, off = _products(_Rounded(a), _Rounded(b))
        assert (np.abs(near - a @ b.T) <= off).all()


def test_reading_stops_early_and_loses_nothing():
    rng = np.random.default_rng(4)
    lists = np.floor(256 * rng.normal(size=(3000, 8)))
    queries = lists[:5] * 2
    own = np.zeros((3000, 5), dtype=bool)
    q, c = T._read(lists, own, queries, np.full(5, -np.inf), 5)
    assert np.bincount(q).max() <= T.FEW * 5 < 3000
    for i in range(5):
        best = np.argsort(-(lists @ queries[i]), kind="stable")[:5]
        assert set(best) <= set(c[q == i])


def test_heaps_keep_the_best_with_ties_to_small_ids():
    heaps = Heaps(1, 2)
    heaps.merge(np.zeros(4, int), np.array([9, 4, 7, 1]), np.array([1.0, 1.0, 2.0, 1.0]))
    at, ids, scores = heaps.rows(float)
    assert sorted(zip(scores, ids)) == [(1.0, 1), (2.0, 7)]
