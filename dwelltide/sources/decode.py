"""Payload decoders.

A payload is bytes or text in one column, and holds exactly one record. By default a payload
that cannot be decoded fails the query; with ``quarantine`` the row stays, its fields null and
its text in a column of its own, for ``split_malformed``. Blank and null payloads, several
values and anything after the first are malformed too.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MALFORMED = "malformed_payload"


def as_struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def decode_text(rows: DataFrame, payload: str = "value") -> DataFrame:
    return rows.select(F.col(payload).cast("string").alias("value"))


def decode_binary(rows: DataFrame, payload: str = "value") -> DataFrame:
    return rows.select(F.col(payload).cast("binary").alias("value"))


def holds_one_value(text: Column, record: T.StructType) -> Column:
    """Whether the text is one JSON value and nothing else.

    The parser stops after a first value, so the text is read again as the first of two
    elements of an array: only then does what follows count.
    """
    both = F.concat(F.lit("["), text, F.lit(",null]"))
    return F.coalesce(F.size(F.from_json(both, T.ArrayType(record))) == 2, F.lit(False))


def one_record(
    text: Column, record: T.StructType | str, options: Mapping[str, str] | None = None
) -> Column:
    """The record a text holds; a text that is not exactly one fails the query.

    It is read once, as the first of two elements of an array."""
    both = F.concat(F.lit("["), text, F.lit(",null]"))
    parsed = F.from_json(both, T.ArrayType(as_struct(record)), {"mode": "FAILFAST", **(options or {})})
    fault = F.concat(F.lit("malformed, not one JSON record: "), F.coalesce(text, F.lit("null")))
    one = (F.size(parsed) == 2) & parsed[0].isNotNull()
    return F.when(one, parsed[0]).otherwise(F.raise_error(fault))


def decode_json(
    rows: DataFrame,
    schema: T.StructType | str,
    payload: str = "value",
    quarantine: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One column per field of ``schema``, after the columns to keep."""
    record = as_struct(schema)
    text = F.col(payload).cast("string")
    if not quarantine:
        parsed = one_record(text, record).alias("parsed")
        return rows.select(*keep, parsed).select(*keep, "parsed.*")
    names = record.fieldNames()
    marked = T.StructType([*record.fields, T.StructField(MALFORMED, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    parsed = rows.select(
        *keep,
        F.from_json(text, marked, options).alias("parsed"),
        F.coalesce(text, F.lit("")).alias("text"),
        holds_one_value(text, record).alias("one"),
    )
    good = F.col("one") & F.col("parsed").isNotNull() & F.col(f"parsed.{MALFORMED}").isNull()
    fields = [F.when(good, F.col(f"parsed.`{name}`")).alias(name) for name in names]
    return parsed.select(*keep, *fields, F.when(~good, F.col("text")).alias(MALFORMED))


def split_malformed(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded rows, and the quarantined ones."""
    good = decoded.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)
    return good, decoded.filter(F.col(MALFORMED).isNotNull())
