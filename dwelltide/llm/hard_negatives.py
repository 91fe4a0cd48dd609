"""Hard negatives by inner product, from STR-packed R-trees searched best first.

All rows are sorted along their first component by Spark, in ranges, and runs of them are packed into
trees by sort-tile-recursion over the following components. A node's bounding box gives an interval
of the inner products that its rows can have with an anchor, component by component. A search keeps a queue of
nodes, highest possible score first, and drops a node whose interval misses every score window
still of interest, or lies strictly below the k-th best score found there.

Two searches: an anchor's positives are its nearest rows of the same label; each of them then
opens a window of scores in which its negatives, rows of other labels, must lie.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwelltide.session import shared_folder

#: Rows of a tree, at most; a leaf's rows, and children of any other node.
TREE_ROWS = 16_384
LEAF_ROWS = 128
FANOUT = 8
#: Anchors that search the trees of a cell together.
GROUP_ANCHORS = 1024
LONG = (-(1 << 63), (1 << 63) - 1)
#: Whole numbers up to here are exact as doubles.
EXACT = 1 << 53

_TREE = "slot long, width int, small boolean, ids binary, labels binary, vectors binary"
_FOUND = "anchor_id long, place int, other_id long, score long"


def str_order(vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> np.ndarray:
    """The order of rows in which each run of ``leaf_rows`` is a leaf: slabs along the first
    component, those cut along the second, and so on."""

    def tile(rows: np.ndarray, axis: int) -> list[np.ndarray]:
        leaves = math.ceil(len(rows) / leaf_rows)
        left = vectors.shape[1] - axis
        if leaves <= 1 or left <= 0:
            return [rows]
        rows = rows[np.argsort(vectors[rows, axis], kind="stable")]
        slabs = max(2, math.ceil(leaves ** (1 / left)))
        # Whole leaves per slab, so that no leaf lies in two.
        step = math.ceil(leaves / slabs) * leaf_rows
        return [x for at in range(0, len(rows), step) for x in tile(rows[at : at + step], axis + 1)]

    parts = tile(np.arange(len(vectors)), 0)
    return np.concatenate(parts) if parts else np.arange(0)


class Tree:
    """Rows in their packed order, and the boxes of every level from the leaves to the root."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.labels, self.vectors = ids, labels, vectors
        low = high = vectors
        size, self.levels = LEAF_ROWS, []
        while not self.levels or len(low) > 1:
            starts = np.arange(0, len(low), size)
            low = np.minimum.reduceat(low, starts, axis=0)
            high = np.maximum.reduceat(high, starts, axis=0)
            self.levels.append((low, high))
            size = FANOUT
        self.largest = float(np.abs(vectors).max(initial=0))

    def rows(self, leaf: int) -> slice:
        return slice(leaf * LEAF_ROWS, (leaf + 1) * LEAF_ROWS)

    def scores(self, rows: slice, query: np.ndarray, exact: bool) -> np.ndarray:
        if exact:
            return (self.vectors[rows] @ query).astype(np.int64)
        whole = [int(x) for x in query]
        sums = [sum(a * int(b) for a, b in zip(whole, row)) for row in self.vectors[rows]]
        return np.array([min(max(s, LONG[0]), LONG[1]) for s in sums], dtype=np.int64)


class Windows:
    """The best ``k`` rows so far of each window ``low <= score <= high``, ties to the smaller id."""

    def __init__(self, lows: list[int], highs: list[int], k: int) -> None:
        self.highs, self.k = np.array(highs, dtype=np.int64), k
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in lows]
        # Scores below these can't be among the best of their window.
        self.floors = np.array(lows, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        fits = allowed[:, None] & (scores[:, None] >= self.floors) & (scores[:, None] <= self.highs)
        for w in np.flatnonzero(fits.any(axis=0)).tolist():
            heap, at = self.heaps[w], np.flatnonzero(fits[:, w])
            for found in zip(scores[at].tolist(), (-ids[at]).tolist()):
                if len(heap) < self.k:
                    heapq.heappush(heap, found)
                elif found > heap[0]:
                    heapq.heapreplace(heap, found)
            if len(heap) == self.k:
                self.floors[w] = max(self.floors[w], heap[0][0])

    def best(self) -> list[list[tuple[int, int]]]:
        """(score, id) of each window, best first."""
        return [[(score, -minus) for score, minus in sorted(heap, reverse=True)] for heap in self.heaps]


def best_first(tree: Tree, query: np.ndarray, allowed: np.ndarray, windows: Windows, seen: list | None = None) -> None:
    """Adds a tree's allowed rows to the windows, as far as they are among the best. ``seen``
    collects the leaves that were read."""
    exact = np.abs(query).sum() * tree.largest < EXACT
    up, down, size = np.maximum(query, 0), np.minimum(query, 0), np.abs(query)
    floors, highs = windows.floors, windows.highs

    def bounds(level: int, part: slice) -> tuple[np.ndarray, np.ndarray]:
        low, high = (box[part] for box in tree.levels[level])
        with np.errstate(over="ignore", invalid="ignore"):
            upper, lower = high @ up + low @ down, low @ up + high @ down
            if not exact:  # doubles may be off by their rounding
                slack = np.maximum(np.abs(low), np.abs(high)) @ size * (len(query) + 4) * 2.0**-50 + 1
                upper, lower = upper + slack, lower - slack
        return np.nan_to_num(upper, nan=np.inf, posinf=np.inf, neginf=-np.inf), np.nan_to_num(
            lower, nan=-np.inf, posinf=np.inf, neginf=-np.inf
        )

    def open_windows(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
        return (upper[:, None] >= floors) & (lower[:, None] <= highs)

    def push(level: int, first: int, upper: np.ndarray, lower: np.ndarray) -> None:
        wanted = open_windows(upper, lower)
        best = np.where(wanted, np.minimum(upper[:, None], highs), -np.inf).max(axis=1)
        for i in np.flatnonzero(wanted.any(axis=1)).tolist():
            heapq.heappush(queue, (-best[i], level, first + i, upper[i], lower[i]))

    queue: list[tuple[float, int, int, float, float]] = []
    if len(tree.ids) and len(floors):
        top = len(tree.levels) - 1
        push(top, 0, *bounds(top, slice(0, 1)))
    while queue:
        _, level, node, upper, lower = heapq.heappop(queue)
        # Floors may have risen since it was queued.
        if not open_windows(np.array([upper]), np.array([lower])).any():
            continue
        if level:
            part = slice(node * FANOUT, (node + 1) * FANOUT)
            push(level - 1, part.start, *bounds(level - 1, part))
            continue
        part = tree.rows(node)
        if seen is not None:
            seen.append(node)
        windows.add(tree.scores(part, query, exact), tree.ids[part], allowed[part])


def _runs(rows: DataFrame, trees: int) -> DataFrame:
    """Packed trees of ``rows(id, label, vector)``, of ``TREE_ROWS`` rows at most."""

    def packed(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, slot: int) -> pa.RecordBatch:
        order = str_order(vectors)
        vectors = vectors[order]
        small = np.abs(vectors).max(initial=0) < 1 << 15
        values = [
            pa.array([slot], pa.int64()),
            pa.array([vectors.shape[1]], pa.int32()),
            pa.array([small], pa.bool_()),
            pa.array([ids[order].tobytes()], pa.binary()),
            pa.array([labels[order].tobytes()], pa.binary()),
            pa.array([vectors.astype(np.int16 if small else np.float64).tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(values, names=["slot", "width", "small", "ids", "labels", "vectors"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, width, held, count = TaskContext.get().partitionId(), None, [], 0

        def closed() -> pa.RecordBatch:
            parts = [np.concatenate(x) for x in zip(*held)]
            return packed(*parts, slot)

        for batch in batches:
            lists = batch.column(2)
            widths = np.asarray(lists.value_lengths(), dtype=np.int64)
            flat = np.floor(np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.float64))
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            starts = np.append(0, np.cumsum(widths))
            edges = np.flatnonzero(np.diff(widths)) + 1
            for first, last in zip(np.append(0, edges), np.append(edges, len(widths))):
                at = first
                while at < last:
                    if held and (widths[at] != width or count == TREE_ROWS):
                        yield closed()
                        # Far from other partitions' slots: a cell gets few trees.
                        held, count, slot = [], 0, slot + 7919
                    width = widths[at]
                    end = min(last, at + TREE_ROWS - count)
                    block = flat[starts[at] : starts[end]].reshape(end - at, width)
                    held.append((ids[at:end], labels[at:end], block))
                    count, at = count + int(end - at), end
        if held:
            yield closed()

    first = F.when(F.size("vector") > 0, F.col("vector")[0])
    ranged = rows.select("id", "label", "vector", F.size("vector").alias("width"), first.alias("first"))
    # By id and label within equal components, so that a vector that is very common is divided too.
    order = ["width", "first", "id", "label"]
    ranged = ranged.repartitionByRange(trees, *order).sortWithinPartitions(*order)
    return ranged.select("id", "label", "vector").mapInArrow(run, _TREE)


def _trees(table: pa.Table) -> Iterator[tuple[int, Tree]]:
    for width, small, ids, labels, vectors in zip(
        *(table.column(c).to_pylist() for c in ("width", "small", "ids", "labels", "vectors"))
    ):
        ids = np.frombuffer(ids, dtype=np.int64)
        kind = np.int16 if small else np.float64
        rows = np.frombuffer(vectors, dtype=kind).reshape(len(ids), width).astype(np.float64)
        yield width, Tree(ids, np.frombuffer(labels, dtype=np.int64), rows)


def _search(trees: DataFrame, anchors: DataFrame, groups: int, stripes: int, k: int, same: bool) -> DataFrame:
    """``(anchor_id, place, other_id, score)``: the best ``k`` of all trees for every window of
    ``anchors(id, label, vector, lows, highs)``; rows of the same label, or those of others."""
    asking = anchors.select(
        F.pmod(F.xxhash64("id"), F.lit(groups)).alias("group"),
        F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"),
        "id", "label", "vector", "lows", "highs",
    )
    given = trees.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"),
        F.pmod("slot", F.lit(stripes)).cast("int").alias("stripe"),
        "width", "small", "ids", "labels", "vectors",
    )

    def cell(asked: pa.Table, held: pa.Table) -> pa.Table:
        rows = asked.select(["id", "label", "vector", "lows", "highs"]).to_pylist()
        # All trees of the cell fill the same windows, so a later one is searched less.
        windows = [Windows(r["lows"], r["highs"], k) for r in rows]
        queries = [np.floor(np.array(r["vector"], dtype=np.float64)) for r in rows]
        for width, tree in _trees(held):
            for r, query, kept in zip(rows, queries, windows):
                if len(query) != width:
                    continue
                alike = tree.labels == r["label"]
                allowed = (alike if same else ~alike) & (tree.ids != r["id"])
                if allowed.any():
                    best_first(tree, query, allowed, kept)
        found = [
            (r["id"], w, i, s) for r, kept in zip(rows, windows) for w, best in enumerate(kept.best()) for s, i in best
        ]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        columns = list(zip(*found)) if found else [[], [], [], []]
        arrays = [pa.array(c, type=t) for c, t in zip(columns, types)]
        return pa.Table.from_arrays(arrays, names=["anchor_id", "place", "other_id", "score"])

    best = asking.groupBy("group", "stripe").cogroup(given.groupBy("group", "stripe")).applyInArrow(cell, _FOUND)
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "other_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    factor: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Each component x counts as floor(``factor`` * x), a score is the integer inner product with
    the anchor, and higher ones come first, ties to the smaller id. An anchor's positives are its
    first ``positives`` other rows of its label; for each, the first ``negatives`` rows of other
    labels follow whose scores are at least ``low_percent`` and at most ``high_percent`` percent of
    the positive's, compared in whole numbers (so a positive below 0 has none).

    Rows without an id or a label take no part, nor do null vectors and those that hold a null or
    a component not finite, times ``factor`` included. Vectors of different lengths are not
    compared; those of length 0 score 0 with each other. Rows are candidates of their own, repeated
    or not, but for rows of the anchor's id; of an anchor id on several rows the smallest vector,
    then label, asks. A score beyond a long counts as its largest or smallest value. With
    too few rows there are fewer results, and none of an empty table. Other columns are not read.

    Every anchor meets every tree, in cells of at most about ``GROUP_ANCHORS`` anchors and a tree
    or two; trees are checkpointed, as two searches read them.
    """
    spark = vectors.sparkSession
    shared_folder(spark)
    # Doubles here, whole numbers where they are packed: Spark's floor would make longs of them.
    times = F.transform(F.col(f"`{vector_col}`").cast("array<double>"), lambda x: x * F.lit(float(factor)))
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        times.alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    ).filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    rows = rows.filter(F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))
    counts = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    cores = spark.sparkContext.defaultParallelism
    stripes = max(1, math.ceil(2 * counts[0] / TREE_ROWS), min(2 * cores, math.ceil(counts[0] / 1024)))
    groups = max(1, math.ceil(counts[1] / GROUP_ANCHORS))
    trees = _runs(rows, stripes).checkpoint()

    one_each = F.min(F.struct("vector", "label")).alias("one")
    anchors = rows.filter("asks").groupBy("id").agg(one_each).select("id", "one.*").checkpoint()

    def bound(value: int) -> Column:
        return F.array(F.lit(value).cast("long"))

    everywhere = anchors.select("*", bound(LONG[0]).alias("lows"), bound(LONG[1]).alias("highs"))
    nearest = _search(trees, everywhere, groups, stripes, positives, same=True)
    score = F.col("score").cast("decimal(38,0)")
    low, high = F.ceil(score * low_percent / 100), F.floor(score * high_percent / 100)
    windows = nearest.filter(low <= high).select(
        F.col("anchor_id"),
        F.struct(
            "rank", F.col("other_id").alias("positive_id"), "score", low.cast("long").alias("low"), high.cast("long").alias("high")
        ).alias("window"),
    )
    # At most ``positives`` windows per anchor.
    windows = windows.groupBy("anchor_id").agg(F.array_sort(F.collect_list("window")).alias("windows")).checkpoint()
    asking = anchors.join(windows.withColumnRenamed("anchor_id", "id"), "id").select(
        "id", "label", "vector", F.col("windows.low").alias("lows"), F.col("windows.high").alias("highs")
    )
    hard = _search(trees, asking, groups, stripes, negatives, same=False)
    return hard.join(windows, "anchor_id").select(
        "anchor_id",
        F.expr("windows[place].positive_id").alias("positive_id"),
        "rank",
        F.col("other_id").alias("negative_id"),
        F.expr("windows[place].score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
