"""Conversations as a trie of shared beginnings.

A node of depth d stands for all conversations that begin with the same d turns. Turns are
hashed where they are read, so texts are never shuffled; a beginning is named by a digest that goes
on from turn to turn. A count-min sketch over all these digests then screens them: it never counts
too few, so a digest estimated once belongs to one conversation, and so does all that
follows. Such tails, most of a corpus, are nodes where they stand. Only beginnings that
may be shared are shuffled and grouped exactly.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwelltide.llm.hot_keys import lookup
from dwelltide.session import shared_folder

# Digests are polynomials in a fixed number, modulo a prime: that of a long conversation can
# be put together from those of its parts, whichever tasks they are in.
PRIME = (1 << 127) - 1
POINT = int.from_bytes(hashlib.sha256(b"a beginning of a conversation").digest()[:15], "big")
HASH_BYTES = 15

#: Rows of the sketch, and the least and the most cells of each. A cell counts none, one or more.
SKETCH_ROWS = 4
CELLS = (1 << 12, 1 << 24)
CHUNK_CELLS = 1 << 18
#: Sketches of tasks that are merged together before those are merged.
MERGED_TOGETHER = 256
#: Turns of a conversation that one task of a join may take.
STRIDE = 4096
#: Ids of a blob, of which the names of a node's ends are made.
BLOB_IDS = 8192
BATCH_ROWS = 50_000

_TURNS = ["base", "follows", "conv", "turn", "hash"]
_PATHS = "conv long, depth long, a long, b long, pa long, pb long, chars long, before long, is_end boolean"
_NAMES = [f.split()[0] for f in _PATHS.split(", ")]
_TYPES = [pa.bool_() if f.endswith("boolean") else pa.int64() for f in _PATHS.split(", ")]
SHARED, HEAD, TAIL = 0, 1, 2


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """``(base, follows, conv, hash as number, chars, head)`` of a batch of sorted turns."""
    columns = [batch.column(c).to_pylist() for c in ("base", "follows", "conv", "hash", "chars", "head")]
    for base, follows, conv, turn_hash, chars, head in zip(*columns):
        yield base, follows, conv, int.from_bytes(turn_hash, "big"), chars, head if follows else 0


@dataclass
class Run:
    """Turns of one conversation that stand together in a partition."""

    base: int
    follows: bool
    conv: int
    head: int
    turns: int = 0
    #: Hash and length of the first of them.
    first: list[tuple[int, int]] = field(default_factory=list)
    #: Of what follows after the first 0, 1, 2, ...: digest, turns, code points.
    after: list[list[int]] = field(default_factory=list)

    def add(self, turn: int, chars: int, max_head: int) -> None:
        self.turns += 1
        if len(self.first) < max_head:
            self.first.append((turn, chars))
        if len(self.after) <= max_head:
            self.after.append([0, 0, 0])
        for part in self.after[: self.turns]:
            part[0] = (part[0] * POINT + turn) % PRIME
            part[1] += 1
            part[2] += chars

    def rest(self, skipped: int) -> list[int]:
        return self.after[skipped] if skipped < len(self.after) else [0, 0, 0]


@dataclass
class Place:
    """Where a conversation stands after some of its turns."""

    base: int | None = None
    conv: int | None = None
    follows: bool = False
    head: int = 0
    turns: int = 0
    depth: int = 0
    digest: int = 0
    chars: int = 0
    #: First turns of the base conversation.
    base_turns: list[tuple[int, int]] = field(default_factory=list)

    def begin(self, base: int, follows: bool, conv: int, head: int) -> Place:
        """The start of a conversation that comes next; its borrowed turns are still to go."""
        known = self.base_turns if follows and base == self.base else []
        return Place(base, conv, follows, head, base_turns=list(known))

    def step(self, turn: int, chars: int) -> None:
        self.digest = (self.digest * POINT + turn) % PRIME
        self.depth += 1
        self.chars += chars

    def borrowed(self) -> list[tuple[int, int]]:
        return self.base_turns[: self.head] if self.follows else []

    def pass_run(self, run: Run, max_head: int) -> Place:
        """After a whole run of turns that comes next."""
        if run.conv == self.conv:
            place = self
        else:
            place = self.begin(run.base, run.follows, run.conv, run.head)
            for turn, chars in place.borrowed():
                place.step(turn, chars)
        digest, turns, chars = run.rest(max(0, place.head - place.turns))
        known = place.base_turns if place.follows else (place.base_turns + run.first)[:max_head]
        return Place(
            place.base, place.conv, place.follows, place.head, place.turns + run.turns, place.depth + turns,
            (place.digest * pow(POINT, turns, PRIME) + digest) % PRIME, place.chars + chars, known,
        )


def _summaries(max_head: int):
    """Per partition its first and its last run, and the base conversation before the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = base = part = None
        for batch in batches:
            if batch.num_rows and part is None:
                part = batch.column("part")[0].as_py()
            for b, follows, conv, turn, chars, head in _rows_of(batch):
                if last is None or last.conv != conv:
                    last = Run(b, follows, conv, head)
                    first = first or last
                    base = base if follows else last
                last.add(turn, chars, max_head)
        if first is not None:
            runs = [r for r in (first, base, last) if r is not None]
            runs = [r for i, r in enumerate(runs) if all(r is not s for s in runs[:i])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([pickle.dumps(runs)], pa.binary())], names=["part", "runs"]
            )

    return run


def carried(parts: list[tuple[int, list[Run]]], max_head: int) -> dict[int, tuple[Place, bool]]:
    """For each partition, where the last conversation of those before stands, and whether its
    own last one has more nodes in those behind."""
    place, before, ends = Place(), {}, {}
    for part, runs in parts:
        before[part] = place
        for run in runs:
            place = place.pass_run(run, max_head)
        ends[part] = place
    found, total = {}, {}
    following: tuple[int, list[Run]] | None = None
    for part, runs in reversed(parts):
        end = ends[part]
        turns = end.turns
        if following is not None and following[1][0].conv == end.conv:
            # One that goes on: its turns in all, wherever they end.
            turns = total[following[0]]
        more = turns > max(end.head, end.turns)
        first = runs[0]
        alone = first.conv == end.conv
        own = first.turns + (before[part].turns if before[part].conv == first.conv else 0)
        total[part] = turns if alone else own
        found[part] = (before[part], more)
        following = (part, runs)
    return found


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _walk(carry: dict[int, tuple[Place, bool]], max_head: int):
    """Nodes on the way of every conversation, in order: one per depth, from the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, more, pending, rows, known = Place(), False, None, [], False

        def flush(is_end: bool) -> None:
            nonlocal pending
            if pending is not None:
                rows.append((*pending, is_end))
            pending = None

        def node(parent: int | None, chars: int) -> None:
            nonlocal pending
            flush(False)
            above = (None, None) if parent is None else (parent >> 64, _signed(parent & (1 << 64) - 1))
            own = (place.digest >> 64, _signed(place.digest & (1 << 64) - 1))
            pending = (place.conv, place.depth, *own, *above, chars, place.chars - chars)

        def turned(turn: int, chars: int) -> None:
            parent = place.digest
            place.step(turn, chars)
            node(parent, chars)

        for batch in batches:
            if batch.num_rows and not known:
                place, more = carry[batch.column("part")[0].as_py()]
                known = True
            for base, follows, conv, turn, chars, head in _rows_of(batch):
                if conv != place.conv:
                    flush(True)
                    place = place.begin(base, follows, conv, head)
                    node(None, 0)
                    for t, c in place.borrowed():
                        turned(t, c)
                place.turns += 1
                if not follows and len(place.base_turns) < max_head:
                    place.base_turns.append((turn, chars))
                if place.turns > place.head:
                    turned(turn, chars)
            if len(rows) >= BATCH_ROWS:
                yield _batch(rows)
                rows.clear()
        flush(not more)
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(c, type=t) for c, t in zip(zip(*rows), _TYPES)]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def cells_of(a: np.ndarray, b: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cells of digests in every row of the sketch."""
    high, low = a.astype(np.int64).view(np.uint64), b.astype(np.int64).view(np.uint64)
    shift, mix = np.uint64(64 - bits), np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        return [((high + np.uint64(r) * low) * mix) >> shift for r in range(SKETCH_ROWS)]


def _sketches(bits: int):
    chunk = min(CHUNK_CELLS, 1 << bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts = np.zeros((SKETCH_ROWS, 1 << bits), dtype=np.uint8)
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            for row, cells in zip(counts, cells_of(a, b, bits)):
                hit, times = np.unique(cells, return_counts=True)
                row[hit] = np.minimum(row[hit].astype(np.int64) + times, 2)
        task = TaskContext.get().partitionId() // MERGED_TOGETHER
        for r, row in enumerate(counts):
            for at in range(0, 1 << bits, chunk):
                part = row[at : at + chunk]
                if part.any():
                    yield _blobs(task, r, at // chunk, np.packbits(part >= 1), np.packbits(part >= 2))

    return run


_SKETCH = "task long, r int, chunk int, once binary, twice binary"


def _blobs(task: int, r: int, chunk: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    # Bitmaps of a task's few digests are nearly empty, and pack well.
    packed = [zlib.compress(bits.tobytes(), 1) for bits in (once, twice)]
    arrays = [pa.array([x], t) for x, t in zip((task, r, chunk, *packed), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))]
    return pa.RecordBatch.from_arrays(arrays, names=["task", "r", "chunk", "once", "twice"])


def _merge(table: pa.Table) -> pa.Table:
    once = twice = None
    for blobs in zip(table.column("once").to_pylist(), table.column("twice").to_pylist()):
        one, two = (np.frombuffer(zlib.decompress(x), dtype=np.uint8) for x in blobs)
        twice = two if twice is None else twice | two | (once & one)
        once = one if once is None else once | one
    keys = [table.column(c)[0].as_py() for c in ("task", "r", "chunk")]
    return pa.Table.from_batches([_blobs(*keys, once, twice)])


def count_min(paths: DataFrame, bits: int) -> np.ndarray:
    """Bitmaps of the cells that counted more than one, one per row of the sketch.

    Of a size that the parameters bound: at most ``SKETCH_ROWS`` times 2 MB."""
    parts = paths.select("a", "b").mapInArrow(_sketches(bits), _SKETCH)
    some = parts.groupBy("task", "r", "chunk").applyInArrow(_merge, _SKETCH).withColumn("task", F.lit(0).cast("long"))
    whole = some.groupBy("task", "r", "chunk").applyInArrow(_merge, _SKETCH).select("r", "chunk", "twice")
    bitmaps = np.zeros((SKETCH_ROWS, (1 << bits) // 8), dtype=np.uint8)
    chunk = min(CHUNK_CELLS, 1 << bits) // 8
    for row in whole.toArrow().to_pylist():
        at = row["chunk"] * chunk
        bitmaps[row["r"], at : at + chunk] = np.frombuffer(zlib.decompress(row["twice"]), dtype=np.uint8)
    return bitmaps


def may_be_shared(bitmaps: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the sketch's estimate of each digest is more than one."""
    bits = int(math.log2(bitmaps.shape[1] * 8))
    found = np.ones(len(a), dtype=bool)
    for row, cells in zip(bitmaps, cells_of(a, b, bits)):
        found &= (row[cells >> np.uint64(3)] >> (np.uint8(7) - (cells & np.uint64(7)).astype(np.uint8))) & 1 == 1
    return found


def _screened(sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = sketch.value
        before, proved = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("conv", "a", "b"))
            at = np.arange(len(conv))
            starts = np.append(conv[0] != before, conv[1:] != conv[:-1])
            # Once alone, alone from there on.
            alone = np.where(may_be_shared(bitmaps, a, b), -1, at)
            if proved and not starts[0]:
                alone[0] = 0
            local = np.maximum.accumulate(alone) >= np.maximum.accumulate(np.where(starts, at, 0))
            follows = np.append(proved, local[:-1]) & ~starts
            kind = np.where(local, np.where(follows, TAIL, HEAD), SHARED).astype(np.int32)
            before, proved = conv[-1], bool(local[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kind)], names=[*_NAMES, "kind"])

    return run


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a node's ids, in order, as joined texts."""
    key, held, rows = None, [], []

    def close() -> None:
        if held:
            rows.append((*key, held[0], ",".join(map(str, held)).encode()))
            held.clear()

    def done() -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        arrays = [pa.array(c, type=t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "first", "ids"])

    for batch in batches:
        for a, b, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if (a, b) != key or len(held) == BLOB_IDS:
                close()
                key = (a, b)
            held.append(conv)
        if rows:
            yield done()
            rows.clear()
    close()
    if rows:
        yield done()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state, rows = None, None, []

    def done() -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array(c, type=t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "ends_sha256"])

    for batch in batches:
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
            if (a, b) == key:
                state.update(b"," + ids)
                continue
            if key is not None:
                rows.append((*key, state.hexdigest()))
            key, state = (a, b), hashlib.sha256(ids)
        if rows:
            yield done()
            rows.clear()
    if key is not None:
        rows.append((*key, state.hexdigest()))
        yield done()


def _ends(shared: DataFrame) -> DataFrame:
    """``(a, b, ends_sha256)`` of the nodes at which conversations end.

    Ranges of a node's ids become texts in many tasks; one then hashes them one after the other, as
    SHA-256 asks for, and holds none of them."""
    ends = shared.filter("is_end").select("a", "b", "conv")
    order = ["a", "b", "conv"]
    blobs = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_ids, "a long, b long, first long, ids binary")
    joined = blobs.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return joined.mapInArrow(_hashed, "a long, b long, ends_sha256 string")


def prefix_trie(
    turns: DataFrame,
    base: Column | None = None,
    head: Column | None = None,
    max_head: int = 8,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """A row per node: the trie's ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (its parent's
    smallest member, null for the root), ``n_convs`` (members), ``n_children``, ``n_leaves``
    (childless nodes of its subtree, itself included), ``saved_tokens`` (over its subtree, code points of
    each node's last text times its members but one) and ``ends_sha256`` (of the ids of
    the members that end there, in order and comma-joined).

    ``base`` and ``head``, expressions of the id, make a conversation begin with the first ``head``
    turns of the conversation ``base`` (all if it has fewer, none if it is not there) in place
    of its own first ``head`` ones; by default it is taken as it is. A base is its own
    base, and ``head`` is at most ``max_head``, else the query fails.

    Turns are in the order of their number, null first; of equal numbers by the SHA-256 of role
    and text. Repeated rows are turns of their own. Null roles and texts are empty ones; rows
    without a conversation id take no part. A conversation left without turns ends at the
    root. Without conversations there is no node. Other columns are not read.

    Turns are divided by ranges of conversation and number, so a conversation of very many is
    many tasks' work; what a partition must know of those before is put together from one small
    row per partition at the driver. Counts are aggregated before every shuffle.
    """
    spark = turns.sparkSession
    shared_folder(spark)
    conv = F.col(f"`{id_col}`").cast("long")
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    named = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    first = conv if base is None else F.coalesce(base.cast("long"), conv)
    taken = F.lit(0) if head is None else F.greatest(F.lit(0), F.coalesce(head.cast("int"), F.lit(0)))
    refused = F.raise_error(F.lit(f"a head of more than max_head={max_head} turns"))
    rows = turns.filter(conv.isNotNull()).select(
        first.alias("base"),
        (first != conv).alias("follows"),
        conv.alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.substring(F.unhex(named), 1, HASH_BYTES).alias("hash"),
        F.char_length(text).cast("long").alias("chars"),
        F.when(taken <= max_head, taken).otherwise(refused).cast("int").alias("head"),
    )
    ranged = rows.repartitionByRange(*_TURNS).sortWithinPartitions(*_TURNS)
    ranged = ranged.drop("turn").withColumn("part", F.spark_partition_id().cast("long")).checkpoint()
    parts = ranged.mapInArrow(_summaries(max_head), "part long, runs binary").toArrow().to_pylist()
    parts = sorted((p["part"], pickle.loads(p["runs"])) for p in parts)
    paths = ranged.mapInArrow(_walk(carried(parts, max_head), max_head), _PATHS).checkpoint()

    bits = max(2, math.ceil(math.log2(4 * paths.count() + 1)))
    bits = min(max(bits, int(math.log2(CELLS[0]))), int(math.log2(CELLS[1])))
    sketch = spark.sparkContext.broadcast(count_min(paths, bits))
    screened = paths.mapInArrow(_screened(sketch), f"{_PATHS}, kind int").checkpoint()
    shared, heads = screened.filter(F.col("kind") == SHARED), screened.filter(F.col("kind") == HEAD)
    return _nodes(screened, shared, heads)


def _alone(rows: DataFrame) -> DataFrame:
    """Nodes of one conversation, as they stand on its way."""
    own = F.when(F.col("is_end"), F.col("conv").cast("string")).otherwise(F.lit(""))
    return rows.select(
        "a", "b", "pa", "pb", "depth",
        F.col("conv").alias("conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("is_end"), 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.sha2(own.cast("binary"), 256).alias("ends_sha256"),
    )


def _nodes(screened: DataFrame, shared: DataFrame, heads: DataFrame) -> DataFrame:
    grouped = shared.groupBy("a", "b").agg(
        F.min("conv").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("before").alias("before"),
        F.max("pa").alias("pa"),
        F.max("pb").alias("pb"),
        F.count(F.lit(1)).alias("n_convs"),
    ).checkpoint()
    above = ["pa", "pb"]
    below = grouped.select(*above).unionByName(heads.select(*above)).filter("pa IS NOT NULL")
    children = below.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = grouped.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.checkpoint()

    # A conversation is its node's smallest member from some depth on. What it shares is the text
    # before that; it is the one to count its leaf if it is alone there, or the smallest.
    smallest = nodes.groupBy(F.col("conv_id").alias("conv")).agg(
        F.min("before").alias("own_from"), F.max(F.col("n_children") == 0).alias("own_leaf")
    )
    is_head = F.col("kind") == HEAD
    ways = screened.filter(F.col("kind") != TAIL).groupBy("conv").agg(
        F.min(F.when(is_head, F.col("before"))).alias("tail_from"),
        F.max(F.when(~is_head, F.col("before") + F.col("chars"))).alias("shared_to"),
        F.max(F.when(~is_head, F.col("depth"))).alias("deepest"),
    )
    ways = ways.filter("deepest IS NOT NULL").join(smallest, "conv", "left").select(
        "conv",
        F.coalesce(F.least("own_from", "tail_from"), "shared_to").alias("until"),
        (F.col("tail_from").isNotNull() | F.coalesce("own_leaf", F.lit(False))).cast("long").alias("leaf"),
        F.explode(F.expr(f"sequence(0L, deepest div {STRIDE})")).alias("stretch"),
    )
    sums = (
        shared.withColumn("stretch", F.expr(f"depth div {STRIDE}"))
        .join(ways, ["conv", "stretch"])
        .groupBy("a", "b")
        .agg(
            F.sum(F.greatest(F.lit(0).cast("long"), F.col("until") - F.col("before"))).alias("saved_tokens"),
            F.sum("leaf").alias("n_leaves"),
        )
    )
    nothing = hashlib.sha256(b"").hexdigest()
    known = nodes.join(sums, ["a", "b"], "left").join(_ends(shared), ["a", "b"], "left")
    known = known.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))
    first = _alone(heads)
    asking = first.unionByName(known.select(*first.columns))
    names = nodes.select("a", "b", F.col("conv_id").alias("parent_conv_id"), "n_children")
    table = names.select(F.col("a").alias("pa"), F.col("b").alias("pb"), "parent_conv_id", "n_children")
    total = nodes.agg(F.coalesce(F.sum("n_children"), F.lit(0))).first()[0]
    placed = lookup(asking, table, ["pa", "pb"], ["parent_conv_id"], "n_children", total, spread=["conv_id", "depth"])
    tails = _alone(screened.filter(F.col("kind") == TAIL)).withColumn("parent_conv_id", F.lit(None).cast("long"))
    # A parent that is no node of the groups is one of the same conversation's own.
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))
    return placed.unionByName(tails).select(
        "conv_id", "depth", parent.alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )
