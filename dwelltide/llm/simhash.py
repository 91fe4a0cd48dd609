"""SimHash fingerprints of texts, and classes of texts whose fingerprints nearly agree.

Candidates come from pigeonring filtering. A fingerprint is a ring of d + 1 segments. If two
fingerprints differ in at most d bits, then from some segment on every chain of l segments
differs in at most l * d / (d + 1) bits: none in the first, one in the first two, and so on.
So rows meet by equal segment, and a pair gets its full comparison only if each longer chain
stays within its budget.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwelltide.llm.components import connected_components
from dwelltide.session import shared_folder

BITS = 64
SEED = 42
#: Fingerprints with the same segment that are compared with each other; more go another way.
COMPARED = 32_768
HASHED_AT_ONCE = 65_536

_SPACES = b"\t\n\v\f\r"
_UPPER = bytes(range(65, 91))
_PLAIN = bytes.maketrans(_SPACES + _UPPER, b" " * len(_SPACES) + _UPPER.lower())


def _words(text: str) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words in lower case (A to Z only) with one space between, their starts and ends."""
    data = text.encode().translate(_PLAIN).strip(b" ")
    if not data:
        return b"", np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    space = raw == 32
    again = space[1:] & space[:-1]
    if again.any():
        raw = raw[np.append(True, ~again)]
        data, space = raw.tobytes(), raw == 32
    gaps = np.flatnonzero(space)
    return data, np.append(0, gaps + 1), np.append(gaps, len(raw))


def simhash(text: str | None, shingle: int = 3) -> int:
    """Bit b is set if more than half of the shingles' hashes have it; no words: 0."""
    data, starts, ends = _words(text or "")
    if not data:
        return 0
    if len(starts) <= shingle:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(starts) - shingle + 1], ends[shingle - 1 :]
    counts = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), HASHED_AT_ONCE):
        part = slice(at, at + HASHED_AT_ONCE)
        hashes = np.array(
            [digest(data[s:e], SEED) for s, e in zip(starts[part].tolist(), ends[part].tolist())],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3
) -> DataFrame:
    """``(id, fingerprint long)`` of every row, from its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (simhash(text.as_py(), shingle) for text in batch.column(1)),
                dtype=np.uint64,
                count=batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["id", "fingerprint"]
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fingerprint long")


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint of each text as a column beside the others of its row."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _signed([simhash(item.as_py(), shingle) for item in batch])

    return F.arrow_udf(run, "long")(text.cast("string"))


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment of the ring."""
    count = max_bits + 1
    cuts = [round(i * BITS / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _linked_in_bucket(prints: np.ndarray, ring: int, max_bits: int) -> list[tuple[int, int]]:
    """Links that join the members of a bucket as all its links would, one less than members
    at most. The members agree in segment ``ring``."""
    segments = _segments(max_bits)
    masks, mask = [], 0
    for step in range(max_bits + 1):
        first, width = segments[(ring + step) % len(segments)]
        mask |= ((1 << width) - 1) << first
        masks.append((np.uint64(mask), (step + 1) * max_bits // (max_bits + 1)))
    joined = np.arange(len(prints))
    links = []
    for j in range(1, len(prints)):
        apart = prints[:j] ^ prints[j]
        near = np.arange(j)
        for mask, budget in masks[1:]:
            near = near[np.bitwise_count(apart[near] & mask) <= budget]
        labels, first = np.unique(joined[near], return_index=True)
        for label, other in zip(labels, near[first]):
            if joined[j] != label:
                links.append((int(prints[other]), int(prints[j])))
                low, high = sorted((label, joined[j]))
                joined[: j + 1][joined[: j + 1] == high] = low
    return links


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64), type=pa.int64())


def _linked_in_partition(max_bits: int, compared: int):
    """Reads ``(ring, segment, fingerprint)`` in order of all three, bucket by bucket."""

    def flush(ring: int, parts: list[np.ndarray]):
        prints = np.unique(np.concatenate(parts))
        return _linked_in_bucket(prints, ring, max_bits) if len(prints) > 1 else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size, spilled = None, [], 0, False

        def emit(links, large=()):
            a = [x for x, _ in links] + list(large)
            b = pa.concat_arrays([_signed([y for _, y in links]), pa.nulls(len(large), pa.int64())])
            return pa.RecordBatch.from_arrays([_signed(a), b], names=["a", "b"])

        for batch in batches:
            ring = batch.column(0).to_numpy()
            segment = batch.column(1).to_numpy()
            prints = batch.column(2).to_numpy().view(np.uint64)
            new = np.flatnonzero((np.diff(ring) != 0) | (np.diff(segment) != 0)) + 1
            links, large = [], []
            for s, e in zip([0, *new.tolist()], [*new.tolist(), len(ring)]):
                if e == s:
                    continue
                if key != (ring[s], segment[s]):
                    if held and size > 1 and not spilled:
                        links += flush(int(key[0]), held)
                    key, held, size, spilled = (ring[s], segment[s]), [], 0, False
                size += e - s
                if size > compared:
                    large += [int(x) for part in [*held, prints[s:e]] for x in part]
                    held, spilled = [], True
                else:
                    held.append(prints[s:e])
            if links or large:
                yield emit(links, large)
        if held and size > 1 and not spilled and (links := flush(int(key[0]), held)):
            yield emit(links)

    return run


def near_links(prints: DataFrame, max_bits: int = 2, compared: int = COMPARED) -> DataFrame:
    """``(a, b)``: links that leave the distinct ``fingerprint`` values connected as all
    pairs within ``max_bits`` bits would.

    Buckets of up to ``compared`` fingerprints are compared by chains. The members of a
    larger bucket meet by the fingerprints one bit from them instead: two that are 2 bits
    apart or less share such a neighbour, and no neighbour has more than 65 (for other
    distances, by neighbours up to half the distance away).
    """
    shared_folder(prints.sparkSession)
    fingerprint = F.col("fingerprint")
    segments = F.array(
        *(
            F.struct(
                F.lit(i).alias("ring"),
                F.shiftrightunsigned(fingerprint, first)
                .bitwiseAND(F.lit((1 << width) - 1 if width < BITS else -1))
                .alias("segment"),
            )
            for i, (first, width) in enumerate(_segments(max_bits))
        )
    )
    rows = prints.select("fingerprint", F.explode(segments).alias("s")).select(
        "s.ring", "s.segment", "fingerprint"
    )
    found = (
        rows.repartition("ring", "segment")
        .sortWithinPartitions("ring", "segment", "fingerprint")
        .mapInArrow(_linked_in_partition(max_bits, compared), "a long, b long")
        .checkpoint()
    )
    links = found.filter(F.col("b").isNotNull())
    large = found.filter(F.col("b").isNull()).select(F.col("a").alias("fingerprint")).distinct()
    return links.unionByName(_links_by_neighbour(large, max_bits))


def _flips(max_flips: int) -> Column:
    """All masks of up to ``max_flips`` bits."""
    masks = {0}
    for _ in range(max_flips):
        masks |= {m ^ (1 << bit) for m in masks for bit in range(BITS)}
    signed = sorted(m - (1 << BITS) if m >> (BITS - 1) else m for m in masks)
    return F.array(*(F.lit(m).cast("long") for m in signed))


def _links_by_neighbour(prints: DataFrame, max_bits: int) -> DataFrame:
    """Fingerprints that share a neighbour meet there; only pairs within bounds are linked."""
    half = (max_bits + 1) // 2
    near = prints.select("fingerprint", F.explode(_flips(half)).alias("flip")).select(
        "fingerprint", F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("centre")
    )
    met = near.groupBy("centre").agg(F.sort_array(F.collect_set("fingerprint")).alias("members"))
    if max_bits % 2 == 0:
        links = met.filter(F.size("members") > 1).select(
            F.col("members")[0].alias("a"), F.explode("members").alias("b")
        )
    else:
        links = met.select("members", F.explode("members").alias("a")).select(
            "a", F.explode("members").alias("b")
        )
        links = links.filter(
            F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
        )
    return links.filter(F.col("a") != F.col("b"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    print_col: str | None = None,
) -> DataFrame:
    """``(id, fingerprint, component, stays, copies)`` of every row of ``docs``.

    Rows belong together if a chain of fingerprints, each at most ``max_bits`` bits from the
    next, leads from one to the other. ``component`` is the smallest id of such a class,
    null if all its ids are null. ``stays`` marks the class's rows of that id (of several
    fingerprints of the id, the smallest); ``copies`` tells how many there are.

    Null and empty texts have no words and the fingerprint 0, linked like any other. A text
    of fewer words than a shingle is one shingle. Repeated rows each keep a row. An empty
    table gives an empty one. Other columns are not read. If ``print_col`` holds the
    fingerprints already, the texts are not read either.

    Equal fingerprints are one row from the first aggregation on, so a group of copies of
    any size weighs as much as one text; only the last join sees its rows, and it needs no
    rows of a key together.
    """
    shared_folder(docs.sparkSession)
    if print_col:
        rows = docs.select(F.col(id_col).alias("id"), F.col(print_col).alias("fingerprint"))
    else:
        rows = fingerprints(docs, id_col, text_col, shingle).checkpoint()
    best = F.struct(F.col("id").isNull().alias("unknown"), "id", "fingerprint", "copies")
    kinds = rows.groupBy("fingerprint", "id").agg(F.count(F.lit(1)).alias("copies"))
    prints = kinds.groupBy("fingerprint").agg(F.min(best).alias("best")).checkpoint()
    links = near_links(prints.select("fingerprint"), max_bits)
    roots = connected_components(links).select(F.col("node").alias("fingerprint"), "root")
    classes = prints.join(roots, "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "best"
    )
    named = classes.groupBy("root").agg(F.min("best").alias("best"))
    of_print = classes.select("fingerprint", "root").join(named, "root").drop("root")
    stays = F.col("id").eqNullSafe(F.col("best.id")) & (
        F.col("fingerprint") == F.col("best.fingerprint")
    )
    return rows.join(of_print, "fingerprint").select(
        F.col("id").alias(id_col),
        "fingerprint",
        F.col("best.id").alias("component"),
        stays.alias("stays"),
        F.col("best.copies").alias("copies"),
    )


def hex_fingerprint(column: str = "fingerprint") -> Column:
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
