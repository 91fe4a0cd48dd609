"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text becomes a vector over hashed byte n-grams (lengths 1 to 3) of its letters in lower
case, weighted by how rare an n-gram is among the learned documents and scaled to length 1.
Every language has several centroids, found by clustering. The nearest centroid by cosine
names the language; a text much farther from it than any learned text of its length is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwelltide.session import shared_folder

UNDETERMINED = "und"
#: Vector components that n-grams are hashed to.
WIDTH = 8192
#: Learned documents per language, at most so many, from which centroids are clustered.
SAMPLE_PER_LANGUAGE = 600
CENTROIDS = 4
ROUNDS = 12
#: Texts of at least so many n-grams have a rejection bound of their own. Below ``LONG`` it comes
#: from the sample's texts of all languages that are as short or shorter: few words tell little,
#: and are kept. From there on it comes from the texts of that length alone.
LENGTHS = (0, 32, 128, 512, 2048)
LONG = 512
#: A text is rejected below this share of the cosine that all but ``OUTSIDE`` of the sample reach.
LENIENCY = 0.25
LONG_LENIENCY = 0.5
OUTSIDE = 0.001
#: With fewer sampled texts of its length, a long text's bound is from all long ones as long or
#: shorter; with fewer of these too, it is that of short texts.
ENOUGH = 100
#: Texts whose vectors stand in memory together.
ROWS_AT_ONCE = 64
BYTES_AT_ONCE = 1 << 20

_LETTER = re.compile(r"[^\W\d_]")
# Bytes of words: letters, and all that UTF-8 uses beyond ASCII; the rest separates.
_PLAIN = bytes(
    b if chr(b).isascii() and chr(b).isalpha() or b >= 128 else 32 for b in range(256)
)


def _has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


def _grams(text: str) -> np.ndarray:
    """How often each component's n-grams stand in the text."""
    raw = np.frombuffer(b" " + text.lower().encode().translate(_PLAIN) + b" ", dtype=np.uint8)
    space = raw == 32
    raw = raw[np.append(True, ~(space[1:] & space[:-1]))]
    counts = np.zeros(WIDTH, dtype=np.float32)
    for at in range(0, len(raw), BYTES_AT_ONCE):
        part = raw[at : at + BYTES_AT_ONCE + 2]
        gram = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, 4):
            # Two bytes more than its own: the n-grams that start in this part.
            gram = gram[: len(part) - n + 1] * np.uint32(256) + part[n - 1 :]
            mixed = (gram[:BYTES_AT_ONCE] + np.uint32(n)) * np.uint32(2_654_435_761)
            counts += np.bincount(mixed >> np.uint32(19), minlength=WIDTH)
    return counts


def _vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, a row per text, and the texts' numbers of n-grams. Nothing but the vectors is
    as large as these: a Python worker keeps what it once took."""
    vectors, sizes = np.empty((len(texts), WIDTH), dtype=np.float32), np.empty(len(texts), dtype=np.float32)
    for at, text in enumerate(texts):
        vector = vectors[at]
        vector[:] = _grams(text)
        sizes[at] = vector.sum()
        np.log1p(vector, out=vector)
        vector *= idf
        vector /= np.maximum(np.sqrt((vector**2).sum()), np.float32(1e-12))
    return vectors, sizes


@dataclass(frozen=True)
class Languages:
    """Learned: rarity per component, centroids with their language, bounds per length."""

    names: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray
    of_language: np.ndarray
    bounds: np.ndarray


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == fold


def _centroids(vectors: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means; starts far apart, so that reruns agree."""
    mean = vectors.mean(axis=0)
    chosen = [vectors[int(np.argmax(vectors @ mean))]]
    while len(chosen) < min(count, len(vectors)):
        nearest = (vectors @ np.stack(chosen).T).max(axis=1)
        chosen.append(vectors[int(np.argmin(nearest))])
    centres = np.stack(chosen)
    for _ in range(ROUNDS):
        own = (vectors @ centres.T).argmax(axis=1)
        sums = np.where(np.bincount(own, minlength=len(centres))[:, None] > 0, np.float32(0), centres)
        for c, vector in zip(own, vectors):
            sums[c] += vector
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def _has_letters(text_col: str) -> Column:
    """Never false for a text that ``_has_letter`` holds for."""
    return F.col(text_col).rlike(r"[\p{L}\p{Nl}\p{No}\p{Cn}]")


def _by_language(values: dict[str, int]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[F.col("lang")]


def _bounds(lengths: np.ndarray, nearest: np.ndarray) -> np.ndarray:
    """The rejection bound of each length, from the sample's lengths and cosines."""
    bounds = []
    for low, below in zip(LENGTHS, (*LENGTHS[1:], np.inf)):
        alike, leniency = nearest[lengths < below], LENIENCY
        for shortest in (low, LONG):
            own = nearest[(lengths >= shortest) & (lengths < below)]
            if low >= LONG and len(own) >= ENOUGH:
                alike, leniency = own, LONG_LENIENCY
                break
        bounds.append(leniency * float(np.quantile(alike, OUTSIDE)) if len(alike) else 0.0)
    return np.array(bounds)


def learn_languages(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
) -> Languages:
    """Learn from the rows of ``docs`` that have a language and a text with a letter.

    The rarity of n-grams is counted over all of them. Centroids and rejection bounds come
    from a sample of at most ``sample_per_language`` documents of each language, those of the
    lowest hashes of id and text; equal rows count once. They are clustered where they are, a task
    per language; the centroids, one count per component and a few times as many hashes reach
    the driver.
    Rows of null language or text, and without letters, teach nothing. Without any row left,
    no language is known.
    """
    shared_folder(docs.sparkSession)
    rows = docs.select(
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text"),
        F.col(id_col).cast("string").alias("id"),
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("lang", "text", F.xxhash64(F.col("id").isNull(), "id", "text").alias("hash"))

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(WIDTH + 1, dtype=np.int64), False
        for batch in batches:
            for text in batch.column(0):
                if _has_letter(t := text.as_py()):
                    total[:WIDTH] += _grams(t) > 0
                    total[WIDTH] += 1
                    seen = True
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(WIDTH + 1), pa.int32()), pa.array(total)], names=["gram", "n"]
            )

    counted = rows.select("text").mapInArrow(document_counts, "gram int, n long")
    with_gram = np.zeros(WIDTH + 1)
    for row in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        with_gram[row["gram"]] = row["n"]
    idf = np.log((1 + with_gram[WIDTH]) / (1 + with_gram[:WIDTH])).astype(np.float32) + 1

    drawn = rows.filter(_has_letters("text"))
    kinds = drawn.groupBy("lang").agg(F.approx_count_distinct("hash", 0.02).alias("n"))
    per_language = {r["lang"]: r["n"] for r in kinds.collect()}
    if not per_language:
        return Languages((), idf, np.zeros((0, WIDTH)), np.zeros(0, int), np.zeros(len(LENGTHS)))
    names = tuple(sorted(per_language))
    # About twice as many as wanted, by the estimated counts; of them the lowest.
    drawn = drawn.filter(F.pmod("hash", _by_language({
        n: max(1, per_language[n] // (2 * sample_per_language)) for n in names
    })) == 0)
    hashes: dict[str, list[int]] = {n: [] for n in names}
    for row in drawn.select("lang", "hash").distinct().collect():
        hashes[row["lang"]].append(row["hash"])
    last = {n: sorted(own)[:sample_per_language][-1] for n, own in hashes.items() if own}
    if last:
        drawn = drawn.filter(F.col("hash") <= _by_language(last)).dropDuplicates(["lang", "hash"])

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(x, t) for x, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if _has_letter(t)]
            for at in range(0, len(pairs), ROWS_AT_ONCE):
                part = pairs[at : at + ROWS_AT_ONCE]
                vectors, sizes = _vectors([t for _, t in part], idf)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x for x, _ in part], pa.string()),
                        pa.array(sizes.astype(np.float64)),
                        pa.array([v.astype(np.float16).tobytes() for v in vectors], pa.binary()),
                    ],
                    names=["lang", "size", "vector"],
                )

    def clustered(table: pa.Table) -> pa.Table:
        """Centroids of one language, and how near the lengths of its sample come to them."""
        packed, sizes = table.column("vector"), np.asarray(table.column("size"))
        unpacked = lambda at: np.frombuffer(packed[int(at)].as_buffer(), dtype=np.float16).astype(np.float32)
        # Rows come in no order of their own.
        order = np.lexsort(([unpacked(at) @ idf for at in range(len(packed))], sizes))
        vectors, lengths = np.empty((len(order), WIDTH), dtype=np.float32), sizes[order]
        for row, at in enumerate(order):
            vectors[row] = unpacked(at)
        centres = _centroids(vectors, CENTROIDS)
        nearest = (vectors @ centres.T).max(axis=1)
        parts = (centres.astype(np.float32), lengths.astype(np.float64), nearest.astype(np.float64))
        arrays = [table.column("lang").slice(0, 1).combine_chunks(), *(pa.array([p.tobytes()], pa.binary()) for p in parts)]
        return pa.Table.from_arrays(arrays, names=["lang", "centres", "lengths", "nearest"])

    sample = drawn.select("lang", "text").mapInArrow(sampled, "lang string, size double, vector binary")
    # At most a sample of rows per language, which one task clusters.
    learned = sample.groupBy("lang").applyInArrow(clustered, "lang string, centres binary, lengths binary, nearest binary")
    by_name = {r["lang"]: r for r in learned.toArrow().to_pylist()}
    centroids, of_language, reached, known = [], [], [], []
    for name in names:
        if name not in by_name:
            continue
        row = by_name[name]
        centres = np.frombuffer(row["centres"], dtype=np.float32).reshape(-1, WIDTH)
        reached.append(tuple(np.frombuffer(row[c], dtype=np.float64) for c in ("lengths", "nearest")))
        centroids.append(centres)
        of_language += [len(known)] * len(centres)
        known.append(name)
    if not known:
        return Languages((), idf, np.zeros((0, WIDTH)), np.zeros(0, int), np.zeros(len(LENGTHS)))
    lengths, nearest = (np.concatenate(x) for x in zip(*reached))
    return Languages(
        tuple(known), idf, np.concatenate(centroids), np.array(of_language), _bounds(lengths, nearest)
    )


def _predicted(texts: list[str | None], model: Languages) -> tuple[list[str], np.ndarray, np.ndarray]:
    names = [UNDETERMINED] * len(texts)
    scores, accepted = np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
    part = [i for i, t in enumerate(texts) if _has_letter(t)] if model.names else []
    if part:
        vectors, sizes = _vectors([texts[i] for i in part], model.idf)
        cosines = vectors @ model.centroids.T
        best = cosines.argmax(axis=1)
        language = model.of_language[best]
        cosine = np.clip(cosines[np.arange(len(part)), best], 0, 1)
        length = np.searchsorted(LENGTHS, sizes, side="right") - 1
        scores[part] = cosine
        accepted[part] = cosine >= model.bounds[length]
        for i, x in zip(part, language):
            names[i] = model.names[x]
    return names, scores, accepted


def identify_languages(docs: DataFrame, model: Languages, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the cosine, 0 to 1) and ``lang_accepted``.

    A null text, or one without a letter, is ``und`` with score 0, and not accepted; so is every
    text if no language was learned. Empty and very long texts are read whole. Ties go to the
    language first by name. Repeated rows are answered alike. Columns of ``docs`` with one of
    these three names are replaced. An empty table gives an empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            # A batch has as many documents as Spark was set to send, however long: few are objects at a time.
            parts = [
                _predicted(texts.slice(at, ROWS_AT_ONCE).to_pylist(), sent.value)
                for at in range(0, len(texts), ROWS_AT_ONCE)
            ]
            names, scores, accepted = zip(*parts) if parts else ((), (), ())
            yield pa.StructArray.from_arrays(
                [
                    pa.array([n for part in names for n in part], pa.string()),
                    pa.array([s for part in scores for s in part.tolist()], pa.float64()),
                    pa.array([a for part in accepted for a in part.tolist()], pa.bool_()),
                ],
                names=["lang_pred", "score", "lang_accepted"],
            )

    # Spark computes a function again on either side of a filter on its result, unless it may change.
    answer = F.arrow_udf(predicted, "lang_pred string, score double, lang_accepted boolean").asNondeterministic()
    found = "found"
    while found in docs.columns:
        found += "_"
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "lang_accepted")]
    answered = docs.withColumn(found, answer(F.col(text_col).cast("string")))
    return answered.select(*(F.col(f"`{c}`") for c in kept), f"{found}.*")
