"""Exact top-k by inner product of whole-number vectors, without random access (NRA).

Each component of the candidates is a sorted list. A query reads the lists of its positive
components from the high end and those of its negative ones from the low end, all to the same
depth. A candidate's unread components lie between the reading place and the list's end, so
its score has a lower and an upper bound. Reading stops when all but a few candidates, for
every query that reads along, can no longer reach the k-th best lower bound; the scores of those
few are then resolved.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from dwelltide.llm.blocks import Heaps, nearest_by_blocks

#: Candidates whose lists are sorted together, and queries that read them together.
LIST_ROWS = 8192
QUERY_ROWS = 128
#: Parts of the lists' length that are read before the bounds are looked at again.
DEPTHS = (1 / 8, 1 / 4, 3 / 8, 1 / 2, 5 / 8, 3 / 4, 1)
#: Open candidates per query, as a multiple of k, that are few enough to resolve.
FEW = 8
LONG = (-(1 << 63), (1 << 63) - 1)


def _whole(vectors: np.ndarray, factor: float) -> np.ndarray:
    return np.floor(factor * vectors)


def _read(lists: np.ndarray, own: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int):
    """(query, candidate) pairs that can be among the best, after reading as far as needed."""
    rows, _ = lists.shape
    ordered = np.sort(lists, axis=0)
    up, down = np.maximum(queries, 0).T, np.minimum(queries, 0).T
    left = np.arange(rows)
    for part in DEPTHS:
        depth = max(1, round(part * rows))
        high, low = ordered[rows - depth], ordered[depth - 1]
        seen = lists[left]
        upper = np.maximum(seen, high) @ up + np.minimum(seen, low) @ down
        lower = np.where(seen >= high, seen, ordered[0]) @ up
        lower += np.where(seen <= low, seen, ordered[-1]) @ down
        lower[own[left]] = -np.inf
        bound = least
        if len(left) > k:
            bound = np.maximum(bound, np.partition(lower, -k, axis=0)[-k])
        open_ = (upper >= bound) & ~own[left]
        if open_.sum(axis=0).max(initial=0) <= FEW * k:
            break
        some = open_.any(axis=1)
        left, open_ = left[some], open_[some]
    c, q = np.nonzero(open_)
    return q, left[c]


def _exactly(queries: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Scores in unlimited whole numbers, held to the range of a long."""
    whole = [np.array([[int(x) for x in row] for row in m], dtype=object) for m in (queries, tile)]
    scores = whole[0] @ whole[1].T
    return np.array([[min(max(s, LONG[0]), LONG[1]) for s in row] for row in scores], dtype=object)


def _search(k: int, factor: float):
    def search(ids, queries, blocks):
        heaps = Heaps(len(ids), k)
        queries = _whole(queries, factor)
        vec_ids = np.concatenate([i for i, _ in blocks])
        vectors = _whole(np.concatenate([v for _, v in blocks]), factor)
        bound = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * queries.shape[1]
        for at in range(0, len(ids), QUERY_ROWS):
            rows = np.arange(at, min(at + QUERY_ROWS, len(ids)))
            for start in range(0, len(vec_ids), LIST_ROWS):
                part = slice(start, start + LIST_ROWS)
                own = vec_ids[part][:, None] == ids[rows]
                if bound >= 1 << 53:
                    scores = _exactly(queries[rows], vectors[part])
                    q, c = np.nonzero(~own.T)
                    found = scores[q, c]
                else:
                    # Whole numbers that this type holds exactly, sums included.
                    kind = np.float32 if bound < 1 << 24 else np.float64
                    tile, asked = vectors[part].astype(kind), queries[rows].astype(kind)
                    q, c = _read(tile, own, asked, heaps.least[rows], k)
                    found = (asked[q] * tile[c]).sum(axis=1).astype(np.int64)
                heaps.merge(rows[q], vec_ids[part][c], found)
        return heaps.rows(np.int64)

    return search


def top_scores(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    factor: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score long)``: per query row the ``k`` other rows of
    highest integer inner product, ties to the smaller id, every component x being
    floor(``factor`` * x).

    The rules of ``blocks`` hold; vectors of zeros take part. Scores beyond a long are its
    largest or smallest value. A query with fewer candidates gets all of them. An empty table
    gives an empty one. Other columns are not read.
    """
    return nearest_by_blocks(vectors, is_query, k, _search(k, factor), "long", id_col, vector_col)
