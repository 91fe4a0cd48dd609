"""A stated set of query vectors against all vectors, block by block.

Vectors are packed into blocks where they are read. A grid of (group of queries, stripe of
candidates) brings every query block together with every candidate block once; a cell's size
is bounded by the parameters, whatever the ids or vectors are. Each cell gives the best of
its stripe per query, and a window keeps the best of all stripes.

Vectors that are null or empty or hold a null or a non-finite component take no part, nor do
rows without an id. Vectors of different lengths are not compared. Every row is a candidate
of its own, repeated or not, but for rows of the query's id; of a query id on several rows the
smallest vector asks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1024
GROUP_QUERIES = 4096
STRIPE_ROWS = 65_536

_BLOCK = "slot long, width int, ids binary, vectors binary"


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors as doubles) of the rows that take part, one pair per length."""
    ids, lists = batch.column(0), batch.column(1)
    known = np.asarray(ids.is_valid()) & np.asarray(lists.is_valid())
    lists = lists.filter(pa.array(known))
    ids = ids.filter(pa.array(known)).to_numpy(zero_copy_only=False).astype(np.int64)
    widths = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
    values = lists.flatten().cast(pa.float64())
    values = np.asarray(values.fill_null(float("nan")).to_numpy(zero_copy_only=False))
    starts = np.append(0, np.cumsum(widths))[:-1]
    for width in np.unique(widths[widths > 0]):
        rows = np.flatnonzero(widths == width)
        vectors = values[starts[rows][:, None] + np.arange(width)]
        good = np.isfinite(vectors).all(axis=1)
        yield ids[rows[good]], vectors[good]


def _packed(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Blocks are dealt in turn, every partition from a place of its own.
        slot = TaskContext.get().partitionId() * 7919
        for batch in batches:
            for ids, vectors in _matrices(batch):
                for at in range(0, len(ids), BLOCK_ROWS):
                    part = slice(at, at + BLOCK_ROWS)
                    slot += 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([slot], pa.int64()),
                            pa.array([vectors.shape[1]], pa.int32()),
                            pa.array([ids[part].tobytes()], pa.binary()),
                            pa.array([vectors[part].tobytes()], pa.binary()),
                        ],
                        names=["slot", "width", "ids", "vectors"],
                    )

    vector = F.col(vector_col).cast("array<double>")
    chosen = rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))
    return chosen.mapInArrow(run, _BLOCK)


def _by_width(table: pa.Table) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for width, ids, vectors in zip(
        table.column("width").to_pylist(),
        table.column("ids").to_pylist(),
        table.column("vectors").to_pylist(),
    ):
        block = np.frombuffer(vectors, dtype=np.float64).reshape(-1, width)
        found.setdefault(width, []).append((np.frombuffer(ids, dtype=np.int64), block))
    return found


#: Of one cell: (query ids, queries, candidate blocks) to (query index, vec id, score) arrays.
Search = Callable[
    [np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]],
    tuple[np.ndarray, np.ndarray, np.ndarray],
]


def nearest_by_blocks(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    search: Search,
    score_type: str,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: per query the ``k`` highest scores, ties to the
    smaller id. ``search`` finds the best ``k`` per query in a cell of the grid."""
    spark = vectors.sparkSession
    asked = vectors.filter(is_query & F.col(id_col).isNotNull())
    counts = vectors.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    cores = spark.sparkContext.defaultParallelism
    groups = max(1, math.ceil(counts[1] / GROUP_QUERIES))
    stripes = max(math.ceil(counts[0] / STRIPE_ROWS), math.ceil(2 * cores / groups))
    one_each = asked.groupBy(F.col(id_col).alias("id")).agg(
        F.min(F.col(vector_col).cast("array<double>")).alias("vector")
    )
    queries = _packed(one_each, "id", "vector").select(
        F.pmod("slot", F.lit(groups)).alias("group"),
        F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"),
        "width", "ids", "vectors",
    )
    candidates = _packed(vectors, id_col, vector_col).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"),
        F.pmod("slot", F.lit(stripes)).cast("int").alias("stripe"),
        "width", "ids", "vectors",
    )

    kind = pa.float64() if score_type == "double" else pa.int64()

    def cell(asking: pa.Table, given: pa.Table) -> pa.Table:
        found, blocks = [], _by_width(given)
        for width, parts in _by_width(asking).items():
            ids = np.concatenate([i for i, _ in parts])
            matrix = np.concatenate([v for _, v in parts])
            if width in blocks:
                at, vec_ids, scores = search(ids, matrix, blocks[width])
                found.append((ids[at], vec_ids, scores))
        columns = [np.concatenate(x) for x in zip(*found)] if found else [[], [], []]
        types = [pa.int64(), pa.int64(), kind]
        arrays = [pa.array(c, type=t) for c, t in zip(columns, types)]
        return pa.Table.from_arrays(arrays, names=["query_id", "vec_id", "score"])

    best = (
        queries.groupBy("group", "stripe")
        .cogroup(candidates.groupBy("group", "stripe"))
        .applyInArrow(cell, f"query_id long, vec_id long, score {score_type}")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


class Heaps:
    """The best ``k`` of each query so far: smallest score first, of equal ones the larger id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(queries)]
        #: Scores below these can't be among the best.
        self.least = np.full(queries, -np.inf)

    def merge(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        import heapq

        good = np.flatnonzero(scores >= self.least[at])
        touched = set()
        for q, vec_id, score in zip(at[good].tolist(), ids[good].tolist(), scores[good].tolist()):
            heap = self.heaps[q]
            if len(heap) < self.k:
                heapq.heappush(heap, (score, -vec_id))
            elif (score, -vec_id) > heap[0]:
                heapq.heapreplace(heap, (score, -vec_id))
            touched.add(q)
        for q in touched:
            if len(self.heaps[q]) == self.k:
                self.least[q] = self.heaps[q][0][0]

    def rows(self, score_type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.repeat(np.arange(len(self.heaps)), [len(h) for h in self.heaps])
        flat = [x for heap in self.heaps for x in heap]
        ids = np.array([-i for _, i in flat], dtype=np.int64)
        return at, ids, np.array([s for s, _ in flat], dtype=score_type)
