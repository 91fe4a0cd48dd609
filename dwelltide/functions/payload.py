"""Rows as payload bytes, and the keys and sizes of the records that carry them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dwelltide.sources.decode import one_record

# Micros and null array elements must survive the trip.
_TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Fixed value: the log's limit for one record.
MAX_RECORD_BYTES = 1024 * 1024


def encode_payload(columns: Sequence[str] | None = None) -> Column:
    """The row, or some of its columns, as UTF-8 JSON bytes."""
    row = F.struct(*columns) if columns else F.struct("*")
    return F.to_json(row, _TIME_FORMATS).cast("binary")


def decode_payload(payload: Column | str, schema: StructType | str) -> Column:
    """The struct that ``encode_payload`` wrote; a payload that is not one fails the query."""
    column = F.col(payload) if isinstance(payload, str) else payload
    return one_record(column.cast("string"), schema, _TIME_FORMATS)


def partition_key(key_columns: Sequence[str]) -> Column:
    """A record's key on the log, from the hash of the given columns.

    All columns spread one entity's results over the log; the entity's own column keeps
    them together and in order.
    """
    return F.xxhash64(*key_columns).cast("string")


def to_records(
    rows: DataFrame,
    key_columns: Sequence[str] | None = None,
    encoder: Callable[[Sequence[str]], Column] | None = None,
    key: Callable[[Sequence[str]], Column] | None = None,
) -> DataFrame:
    """Rows as ``(partition_key, payload)``; ``encoder`` and ``key`` make them from the names
    of the columns in place of JSON and of the hash of ``key_columns``."""
    names = key_columns or rows.columns
    return rows.select(
        (key or partition_key)(names).cast("string").alias("partition_key"),
        (encoder or encode_payload)(rows.columns).cast("binary").alias("payload"),
    )


def is_oversized(payload: Column | str, limit: int = MAX_RECORD_BYTES) -> Column:
    return F.octet_length(payload) > F.lit(limit)
