"""Approximate nearest neighbours by a block matrix join with certain error bounds.

Vectors are rounded to int8 with one scale each. The product of two int8 tiles gives all
inner products of a tile up to an error that is bounded by the rounding errors' lengths. Pairs
whose upper bound falls short of a query's k-th best are done with; the others are computed
again from the original vectors and merged into the query's heap. As the bounds hold, no
neighbour is lost: recall is 1.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from dwelltide.llm.blocks import Heaps, nearest_by_blocks

QUERY_ROWS = 512
PAIRS_AT_ONCE = 65_536
#: Room for the rounding of the bounds themselves.
SLACK = 1e-9


class _Rounded:
    """Vectors as int8 codes, with the lengths that bound what rounding changed."""

    def __init__(self, vectors: np.ndarray):
        scale = np.abs(vectors).max(axis=1) / 127
        codes = np.rint(np.divide(vectors, scale[:, None], where=scale[:, None] > 0, out=np.zeros_like(vectors)))
        self.codes = codes.clip(-127, 127).astype(np.int8)
        self.scale = scale
        restored = self.codes * scale[:, None]
        self.error = np.sqrt(((vectors - restored) ** 2).sum(axis=1)) * (1 + SLACK)
        self.length = np.sqrt((vectors**2).sum(axis=1)) * (1 + SLACK)


def _products(queries: _Rounded, tile: _Rounded) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of the rounded vectors, and how far the true ones may be from them."""
    width = queries.codes.shape[1]
    # Sums of int8 products are whole numbers that this type holds exactly.
    kind = np.float32 if width * 127 * 127 < 1 << 24 else np.float64
    sums = queries.codes.astype(kind) @ tile.codes.astype(kind).T
    near = sums.astype(np.float64) * queries.scale[:, None] * tile.scale
    off = np.outer(queries.error, tile.length + tile.error) + np.outer(queries.length, tile.error)
    return near, off + SLACK * np.outer(queries.length, tile.length)


def _exact(queries: np.ndarray, tile: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed component by component in order, so that
    equal vectors score alike wherever they stand."""
    out = np.empty(len(q))
    for at in range(0, len(q), PAIRS_AT_ONCE):
        part = slice(at, at + PAIRS_AT_ONCE)
        out[part] = np.add.reduce((queries[q[part]] * tile[c[part]]).T.copy(), axis=0)
    return out


def _search(k: int):
    def search(ids, queries, blocks):
        heaps = Heaps(len(ids), k)
        asked = queries.any(axis=1)
        parts = [np.flatnonzero(asked)[a : a + QUERY_ROWS] for a in range(0, len(ids), QUERY_ROWS)]
        parts = [(rows, _Rounded(queries[rows])) for rows in parts if len(rows)]
        for vec_ids, tile in blocks:
            some = tile.any(axis=1)
            vec_ids, tile = vec_ids[some], tile[some]
            if not len(vec_ids):
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                rounded = _Rounded(tile)
                for rows, part in parts:
                    near, off = _products(part, rounded)
                    own = ids[rows][:, None] == vec_ids
                    high = np.where(own, -np.inf, np.nan_to_num(near + off, nan=np.inf, posinf=np.inf, neginf=-np.inf))
                    high[~own & np.isneginf(high)] = np.inf
                    bound = heaps.least[rows]
                    if len(vec_ids) > k:
                        low = np.where(own, -np.inf, np.nan_to_num(near - off, nan=-np.inf, posinf=-np.inf))
                        bound = np.maximum(bound, np.partition(low, -k, axis=1)[:, -k])
                    q, c = np.nonzero((high >= bound[:, None]) & ~own)
                    heaps.merge(rows[q], vec_ids[c], _exact(queries[rows], tile, q, c))
        return heaps.rows(np.float64)

    return search


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: per query row the ``k`` other rows of largest
    inner product, nearest first, ties to the smaller id.

    Beside the rules of ``blocks``, vectors of zeros take no part. A query with fewer
    candidates gets all of them; without any, no row. Inner products beyond the range of
    doubles are infinite, and rank so. An empty table gives an empty one. Other columns are
    not read.
    """
    return nearest_by_blocks(vectors, is_query, k, _search(k), "double", id_col, vector_col)
