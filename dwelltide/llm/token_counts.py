"""Token counts by a two-tier lookup of pre-token lengths, without a shuffle.

A byte-level BPE splits a text into pre-tokens and encodes each on its own, so a text's count
is the sum of its pre-tokens' lengths. Lengths of frequent pre-tokens, those that a public
vocabulary holds whole, are sent to all executors once; the others are encoded when met and kept in a cache
of the worker.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Pre-tokens kept in a worker's cache; then it starts anew.
CACHED = 500_000
#: Longer texts are split as they are read, without a list of their pre-tokens.
LISTED_LENGTH = 1_000_000
#: Longer pre-tokens are not kept.
CACHED_LENGTH = 64

# Fixed value: the split of byte-level BPE vocabularies of this kind.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters that both this process's and the library's character tables class alike; texts
# with others are split by the library, and their pre-tokens looked up like the rest.
_OTHER = regex.compile(r"[^\u0000-ԯ -⁤₠-₿぀-ゖァ-ヺ一-鿋가-힣]")
_SPLIT = regex.compile(SPLIT)



def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes a byte as a letter: visible ones of Latin-1 as themselves, the
    others by the code points from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTES = _byte_letters()


def _lettered(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(_BYTES)


class _Lengths(dict):
    """Pre-token lengths: the sent ones, and those met since; by the pre-tokens' characters, or by
    the letters of their bytes."""

    def __init__(self, known: dict[str, int], tokenizer: Tokenizer, lettered: bool):
        self.known = {_lettered(p): n for p, n in known.items()} if lettered else known
        super().__init__(self.known)
        self.encode, self.lettered = tokenizer.model.tokenize, lettered

    def __missing__(self, piece: str) -> int:
        length = len(self.encode(piece if self.lettered else _lettered(piece)))
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= len(self.known) + CACHED:
                self.clear()
                self.update(self.known)
            self[piece] = length
        return length


#: Where a long text may be cut without changing its pre-tokens: before a space between
#: letters, and between a letter and a full stop or comma of CJK texts.
_CUT = regex.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])|(?<=[一-鿋])(?=[。，、])")


def _parts(text: str) -> Iterator[str]:
    """The text in parts of about ``LISTED_LENGTH``, so that no list of all its pre-tokens exists."""
    at = 0
    while len(text) - at > LISTED_LENGTH:
        cut = _CUT.search(text, at + LISTED_LENGTH)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class _Counter:
    def __init__(self, definition: str, known: dict[str, int]):
        self.tokenizer = Tokenizer.from_str(definition)
        # A special token's string in a text is one token, and splits the text.
        special = [t["content"] for t in json.loads(definition).get("added_tokens") or []]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.lengths = _Lengths(known, self.tokenizer, False)
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.known, self._by_letters = known, None

    def by_letters(self) -> _Lengths:
        if self._by_letters is None:  # built with the first text that needs it
            self._by_letters = _Lengths(self.known, self.tokenizer, True)
        return self._by_letters

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special and self.special.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if _OTHER.search(text):
            lengths = self.by_letters()
            return sum(lengths[piece] for part in _parts(text) for piece, _ in self.split(part))
        if len(text) <= LISTED_LENGTH:
            return sum(map(self.lengths.__getitem__, _SPLIT.findall(text)))
        return sum(self.lengths[match[0]] for match in _SPLIT.finditer(text))


#: Counters of this worker process, by tokenizer.
_COUNTERS: dict[str, _Counter] = {}


def _counter(key: str, sent: Broadcast) -> _Counter:
    if key not in _COUNTERS:
        _COUNTERS[key] = _Counter(*sent.value)
    return _COUNTERS[key]


def _definition(spark: SparkSession, path: str) -> str:
    """The tokenizer file, wherever it lies: by Spark if it has a scheme, else as a local file
    of the driver."""
    if "://" in path:
        return spark.read.text(path, wholetext=True).first()["value"]
    with open(path, encoding="utf-8") as file:
        return file.read()


def _checked(definition: str) -> dict:
    content = json.loads(definition)
    split = content.get("pre_tokenizer") or {}
    if (
        content["model"]["type"] != "BPE"
        or content.get("normalizer")
        or split.get("type") != "ByteLevel"
        or split.get("add_prefix_space")
        or not split.get("use_regex", True)
    ):
        raise ValueError("only byte-level BPE without normalizer and prefix space is known here")
    return content


def frequent_lengths(definition: str) -> dict[str, int]:
    """Lengths of the vocabulary's entries that are whole pre-tokens: a table no larger than
    the vocabulary."""
    tokenizer = Tokenizer.from_str(definition)
    entries = [tokenizer.decode([i]) for i in range(tokenizer.get_vocab_size())]
    whole = [e for e in entries if e and "�" not in e and _SPLIT.fullmatch(e)]
    whole = [e for e in dict.fromkeys(whole) if _SPLIT.findall(e) == [e]]
    encoded = tokenizer.encode_batch(whole, add_special_tokens=False)
    return {piece: len(e.ids) for piece, e in zip(whole, encoded)}


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    text_col: str = "text",
    limit: int = 512,
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``tokenizer`` is the path of a byte-level BPE in the tokenizers library's format. Counts are
    the library's, without tokens added at begin or end, truncation or padding; strings of
    special tokens inside a text count as that token. Null and empty texts have 0 bytes and
    tokens. Whole texts are counted, however long. Repeated rows are counted alike. Columns
    of ``docs`` with one of the three names are replaced. An empty table gives an empty one.

    Nothing is shuffled: the table of frequent pre-tokens is at most as large as the vocabulary,
    and the workers' caches hold at most ``CACHED`` short entries.
    """
    spark = docs.sparkSession
    definition = _definition(spark, tokenizer)
    _checked(definition)
    sent = spark.sparkContext.broadcast((definition, frequent_lengths(definition)))
    key = hashlib.sha256(definition.encode()).hexdigest()

    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(key, sent)
        for texts in batches:
            yield pd.Series([counter.count(t) for t in texts], dtype="int64")

    count = F.pandas_udf(counted, "long")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = ("n_bytes", "n_tokens", "over_limit")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    numbers = docs.select(
        *kept, F.octet_length(text).cast("long").alias("n_bytes"), count(text).alias("n_tokens")
    )
    return numbers.withColumn("over_limit", F.col("n_tokens") > limit)
