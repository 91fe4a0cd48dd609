"""Hard negatives against plain loops; the trees and their search on their own."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dwelltide.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, id string, score string, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "i", "s", "v") for r in rows], SCHEMA).repartition(3)


def plain(rows, every=100, positives=5, negatives=10, low=30, high=90):
    def fine(v):
        return v is not None and all(x is not None and math.isfinite(256 * x) for x in v)

    good = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows if i is not None and c is not None and fine(v)]
    asked = {}
    for i, v, c in good:
        if i % every == 0:
            asked[i] = min(asked.get(i, (v, c)), (v, c))
    out = []
    for a, (q, label) in asked.items():
        scored = [
            (min(max(sum(x * y for x, y in zip(q, v)), H.LONG[0]), H.LONG[1]), i, c)
            for i, v, c in good if i != a and len(v) == len(q)
        ]
        best = sorted((-s, i) for s, i, c in scored if c == label)[:positives]
        for p, i in best:
            inside = sorted((-s, j) for s, j, c in scored if c != label and low * -p <= 100 * s <= high * -p)
            out += [(a, i, n + 1, j, -p, -s) for n, (s, j) in enumerate(inside[:negatives])]
    return sorted(out)


def rows_of(seed, n=700, width=6):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, width)) * 0.3
    vectors[300:420] = vectors[300]  # a group of copies: ties
    rows = [(i, [float(x) for x in v], int(rng.integers(4))) for i, v in enumerate(vectors)]
    nan, inf = float("nan"), float("inf")
    rows += [
        (800, None, 1), (900, [nan] * width, 1), (901, [None] * width, 1), (1000, [0.5] * width, None), (1100, [], 2),
        (1101, [], 2), (1102, [], 3), (1200, [0.1] * (width + 1), 0), (1201, [0.2] * (width + 1), 0), (1202, [0.1] * (width + 1), 1),
        (None, [0.4] * width, 1), (1300, [inf] + [0.0] * (width - 1), 0), (5, rows[5][1], rows[5][2]), (100, rows[5][1], 3),
        (1301, [1e308] * width, 0), (1400, [0.0] * width, 1), (-100, [-0.4] * width, 2),
    ]
    return rows


@pytest.mark.parametrize("leaf,tree", [(128, 16_384), (4, 64)])
def test_as_by_loops(spark, monkeypatch, leaf, tree):
    monkeypatch.setattr(H, "LEAF_ROWS", leaf)
    monkeypatch.setattr(H, "TREE_ROWS", tree)
    monkeypatch.setattr(H, "FANOUT", 3)
    monkeypatch.setattr(H, "GROUP_ANCHORS", 4)
    rows = rows_of(3)
    found = H.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0).collect()
    assert len(found) > 200
    assert sorted(map(tuple, found)) == plain(rows)


def test_scores_beyond_doubles_and_longs(spark):
    rng = np.random.default_rng(9)
    rows = [(i * 50, [float(x) for x in rng.normal(size=4) * 10.0 ** (i % 9)], i % 2) for i in range(60)]
    rows += [(9001, [1e200, 0.0, 0.0, 0.0], 0), (9100, [1e200, 1e5, 0.0, 1.0], 0), (9102, [1.0, 2.0**40, 3.0, 2.0**41], 1)]
    found = H.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, found)) == plain(rows)


def test_few_and_no_rows(spark):
    few = [(0, [1.0, 2.0], 1), (1, [2.0, 1.0], 1), (2, [0.5, 0.5], 2), (3, [1.0, 0.5], None)]
    found = H.hard_negatives(frame(spark, few), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, found)) == plain(few) and found
    assert H.hard_negatives(frame(spark, []), F.col("vec_id") % 100 == 0).collect() == []


def test_tree_order_and_boxes(monkeypatch):
    monkeypatch.setattr(H, "FANOUT", 4)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(1000, 3))
    order = H.str_order(vectors, 10)
    assert sorted(order.tolist()) == list(range(1000))
    monkeypatch.setattr(H, "LEAF_ROWS", 10)
    tree = H.Tree(np.arange(1000)[order], np.zeros(1000), vectors[order])
    assert [len(low) for low, _ in tree.levels] == [100, 25, 7, 2, 1]
    # Packed leaves are far smaller than runs of unsorted rows.
    volume = [np.prod(high - low, axis=1).mean() for low, high in (tree.levels[0], H.Tree(np.arange(1000), np.zeros(1000), vectors).levels[0])]
    assert volume[0] < volume[1] / 20
    for low, high in tree.levels:
        assert (low.min(axis=0) == vectors.min(axis=0)).all() and (high.max(axis=0) == vectors.max(axis=0)).all()


def test_search_reads_few_leaves_of_clustered_rows(monkeypatch):
    monkeypatch.setattr(H, "LEAF_ROWS", 16)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 3)) * 100
    vectors = np.floor(np.concatenate([c + rng.normal(size=(100, 3)) for c in centres]))
    order = H.str_order(vectors, 16)
    tree = H.Tree(np.arange(4000)[order], np.zeros(4000), vectors[order])
    query, every = vectors[0], np.ones(4000, dtype=bool)
    scores = tree.vectors @ query
    top = int(scores.max())
    lows, highs = [-top, int(0.3 * top)], [top, int(0.5 * top)]
    seen, windows = [], H.Windows(lows, highs, 5)
    H.best_first(tree, query, every, windows, seen)
    for low, high, best in zip(lows, highs, windows.best()):
        pairs = sorted((-int(s), int(i)) for s, i in zip(scores, tree.ids) if low <= s <= high)[:5]
        assert best == [(-s, i) for s, i in pairs]
    assert len(seen) == len(set(seen)) < len(tree.levels[0][0]) / 4
    # A second tree with the same rows has little to add, and is hardly read.
    again = []
    H.best_first(tree, query, tree.ids % 2 == 0, windows, again)
    assert len(again) <= len(seen)
    none = H.Windows(lows, highs, 5)
    H.best_first(tree, query, ~every, none)
    assert none.best() == [[], []]


def test_query_matches_sql(spark, sf_dir, llm, duck):
    import __spark_entry__ as entry_module

    for name in ("op11_hard_negatives", "op13_web_archives"):
        found = llm[name](spark, sf_dir)
        expected = duck.sql(entry_module.oracle_sql()[name])
        assert sorted(found.columns) == sorted(expected.columns)
        rows = sorted(map(repr, map(tuple, found.select(*expected.columns).collect())))
        assert rows and rows == sorted(map(repr, expected.fetchall()))
