"""Packing texts into sequences of several permitted lengths, by variable-capacity best fit.

Pieces go, longest first, into the open bin that they fill best. If none has room, a new bin
is opened in the size that costs least per word it can still hold. At the end every bin is
downsized to the smallest permitted length that holds its contents. All permitted lengths are
optimised together: each is tried as the largest size to open, and the cheapest packing is
kept.

Rows are packed in the task that reads them, up to a number of words at a time: nothing is
shuffled, a bin never spans two tasks, and a task that is run again packs the same.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTHS = (512, 1024, 2048, 4096)
#: Rows, and words, that are packed together.
ROWS_TOGETHER = 8192
WORDS_TOGETHER = 4_000_000
#: Rows that go back to Spark at once.
ROWS_SENT = 1000

#: Words of longer texts are counted without a list of them.
LISTED_LENGTH = 1_000_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sequence_cost(length: int) -> float:
    """Cost of a sequence: its words, a share that grows with the square, and a fixed part."""
    return 64 + length + length * length / 65_536


def best_fit(
    sizes: Sequence[int],
    lengths: Sequence[int],
    largest: int,
    cost: Callable[[int], float] = sequence_cost,
) -> tuple[list[int], list[int]]:
    """(bin of each item, length of each bin) if bins are opened up to the length ``largest``,
    or more where an item needs it. No size may exceed the longest length."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    left = sum(sizes)
    where, opened, used = [0] * len(sizes), [], []
    room: list[tuple[int, int]] = []  # (free words, bin), in order
    for item in order:
        size = sizes[item]
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, number = room.pop(at)
        else:
            fitting = [c for c in lengths if size <= c <= max(largest, size)]
            fitting = fitting or [min(c for c in lengths if c >= size)]
            length = min(fitting, key=lambda c: (cost(c) / max(1, min(c, left)), c))
            free, number = length, len(opened)
            opened.append(length)
            used.append(0)
        where[item] = number
        used[number] += size
        left -= size
        insort(room, (free - size, number))
    return where, [min(c for c in lengths if c >= words) for words in used]


def packed_together(
    sizes: Sequence[int],
    lengths: Sequence[int],
    cost: Callable[[int], float] = sequence_cost,
) -> tuple[list[int], list[int]]:
    """The cheapest of the packings by each largest size to open; of equal ones the first."""
    lengths = sorted(set(lengths))
    packings = [best_fit(sizes, lengths, largest, cost) for largest in lengths]
    return min(packings, key=lambda p: sum(map(cost, p[1])))


def _pieces(text: str, longest: int) -> list[tuple[int, int, int]]:
    """(start, end, words) of the parts of a text of at most ``longest`` words, which together
    are the whole text."""
    if len(text) <= LISTED_LENGTH:
        words = len(text.encode().split())
    else:
        words = sum(1 for _ in _WORD.finditer(text))
    if words <= longest:
        return [(0, len(text), words)]
    pieces, start, seen = [], 0, 0
    for match in _WORD.finditer(text):
        if seen and seen % longest == 0:
            pieces.append((start, match.start(), longest))
            start = match.start()
        seen += 1
    pieces.append((start, len(text), seen - longest * len(pieces)))
    return pieces


def pack_sequences(
    docs: DataFrame,
    lengths: Sequence[int] = LENGTHS,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """A row per piece of a text: ``(id, piece, start, end, words, sequence, place,
    sequence_length, sequence_words)``, and its ``text`` if asked for.

    ``sequence`` names the bin, ``place`` is the piece's first word inside it, ``start`` and
    ``end`` are code points of the text. A text of up to the longest length is one piece, a
    longer one is cut between words; pieces together are the whole text. Null texts, and texts
    without words, have one piece of 0 words, in a full sequence if there is one. Repeated
    rows are packed each. Ties go to the bin opened first. An empty table gives an empty one.
    Other columns are not read.
    """
    lengths = tuple(sorted({int(c) for c in lengths}))
    if not lengths or lengths[0] < 1:
        raise ValueError("need at least one length, each of a word or more")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "piece", "start", "end", "words", "sequence", "place", "sequence_length", "sequence_words"]
    names += ["text"] if with_text else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, chunk = TaskContext.get().partitionId(), 0
        ids, texts, held, words_held = [], [], [], 0
        # However Spark cuts the rows into batches, those packed together are the same.
        for batch in batches:
            id_type = batch.column(0).type
            for row in range(batch.num_rows):
                text = batch.column(1)[row].as_py()
                for number, (start, end, words) in enumerate(_pieces(text or "", lengths[-1])):
                    held.append((len(ids), number, start, end, words))
                    words_held += words
                ids.append(batch.column(0)[row].as_py())
                texts.append(text if with_text else None)
                if len(ids) == ROWS_TOGETHER or words_held >= WORDS_TOGETHER:
                    yield from sent(packed(pa.array(ids, type=id_type), texts, held, f"{task}-{chunk}"))
                    chunk += 1
                    ids, texts, held, words_held = [], [], [], 0
        if ids:
            yield from sent(packed(pa.array(ids, type=id_type), texts, held, f"{task}-{chunk}"))

    def sent(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, rows.num_rows, ROWS_SENT):
            yield rows.slice(at, ROWS_SENT)

    def packed(ids, texts, held, name: str) -> pa.RecordBatch:
        where, sizes = packed_together([h[4] for h in held], lengths)
        filled = [0] * len(sizes)
        places = []
        for (*_, words), number in zip(held, where):
            places.append(filled[number])
            filled[number] += words
        row, piece, start, end, words = map(list, zip(*held))
        columns = [
            ids.take(pa.array(row)),
            pa.array(piece, pa.int32()),
            pa.array(start, pa.int64()),
            pa.array(end, pa.int64()),
            pa.array(words, pa.int64()),
            pa.array([f"{name}-{b}" for b in where], pa.string()),
            pa.array(places, pa.int64()),
            pa.array([sizes[b] for b in where], pa.int32()),
            pa.array([filled[b] for b in where], pa.int64()),
        ]
        if with_text:
            whole = [texts[r] for r in row]
            cut = [t if t is None else t[s:e] for t, s, e in zip(whole, start, end)]
            columns.append(pa.array(cut, pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"id {kind}, piece int, start long, end long, words long, sequence string, place long, sequence_length int, sequence_words long"
    found = rows.mapInArrow(run, schema + (", text string" if with_text else ""))
    return found.withColumnRenamed("id", id_col)
