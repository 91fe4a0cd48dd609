"""Rows as JSON text by the proto3 rules, and such text as rows.

lowerCamelCase names; fields holding their default (0, "", false, no bytes, empty array or
map) omitted; 64-bit integers as strings; bytes as base64; times as UTC text. An absent
message is null here and omitted; a present one is written even when all its fields are
defaults.
"""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwelltide.sources.decode import as_struct, one_record


def json_name(name: str) -> str:
    return re.sub(r"_+([^_]?)", lambda m: m.group(1).upper(), name)


def _value(column: Column, kind: T.DataType) -> Column:
    """A present value in its JSON form."""
    if isinstance(kind, T.StructType):
        return F.when(column.isNotNull(), _message(column, kind))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda item: _value(item, kind.elementType))
    if isinstance(kind, T.MapType):
        texts = F.transform_keys(column, lambda key, _: key.cast("string"))
        return F.transform_values(texts, lambda _, item: _value(item, kind.valueType))
    if isinstance(kind, (T.LongType, T.DecimalType)):
        return column.cast("string")
    if isinstance(kind, T.BinaryType):
        return F.base64(column)
    if isinstance(kind, T.TimestampType):
        return F.date_format(
            F.convert_timezone(F.current_timezone(), F.lit("UTC"), column.cast("timestamp_ntz")),
            "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
        )
    return column


def _unless_default(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.when(F.octet_length(column) > 0, column)
    if isinstance(kind, T.BooleanType):
        return F.when(column, column)
    if isinstance(kind, T.NumericType):
        return F.when(column != F.lit(0).cast(kind), column)
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.when(F.size(column) > 0, column)
    return column


def _message(parent: Column | None, schema: T.StructType, optional: Collection[str] = ()) -> Column:
    fields = []
    for field in schema.fields:
        column = F.col(f"`{field.name}`") if parent is None else parent.getField(field.name)
        if field.name not in optional:
            column = _unless_default(column, field.dataType)
        fields.append(_value(column, field.dataType).alias(json_name(field.name)))
    return F.struct(*fields)


def proto_json(rows: DataFrame, optional: Collection[str] = ()) -> Column:
    """The whole row as proto3 JSON; ``optional`` columns keep their defaults."""
    return F.to_json(_message(None, rows.schema, optional))


#: Written as texts, and read from texts as well as from numbers.
_AS_TEXT = (T.LongType, T.DecimalType, T.BinaryType, T.TimestampType, T.FloatType, T.DoubleType)


def _names(field: T.StructField) -> list[str]:
    """The names under which a field may stand: its JSON name, and its own."""
    return list(dict.fromkeys([json_name(field.name), field.name]))


def _read_as(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(n, _read_as(f.dataType)) for f in kind for n in _names(f)])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_read_as(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(T.StringType(), _read_as(kind.valueType))
    return T.StringType() if isinstance(kind, _AS_TEXT) else kind


def _present(column: Column, kind: T.DataType) -> Column:
    """A value that stands in the text, in its type."""
    if isinstance(kind, T.StructType):
        return F.when(column.isNotNull(), _fields(column, kind))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda item: _present(item, kind.elementType))
    if isinstance(kind, T.MapType):
        values = F.transform_values(column, lambda _, item: _present(item, kind.valueType))
        return F.transform_keys(values, lambda key, _: key.cast(kind.keyType))
    if isinstance(kind, T.BinaryType):
        return F.unbase64(column)
    return column.cast(kind) if isinstance(kind, _AS_TEXT) else column


def _default(kind: T.DataType) -> Column | None:
    """What an omitted field holds; messages, times and dates are then absent."""
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BinaryType):
        return F.lit(b"")
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.array().cast(kind)
    if isinstance(kind, T.MapType):
        return F.create_map().cast(kind)
    return None


def _fields(parent: Column, schema: T.StructType, optional: Collection[str] = ()) -> Column:
    fields = []
    for field in schema.fields:
        found = F.coalesce(*[parent.getField(n) for n in _names(field)])
        column, default = _present(found, field.dataType), _default(field.dataType)
        if default is not None and field.name not in optional:
            column = F.coalesce(column, default)
        fields.append(column.alias(field.name))
    return F.struct(*fields)


def from_proto_json(text: Column, schema: T.StructType | str, optional: Collection[str] = ()) -> Column:
    """The record that ``proto_json`` wrote: camelCase names (or the fields' own), 64-bit numbers as
    texts or numbers, base64, and defaults for what is omitted; ``optional`` columns are null then.

    A text that is not one JSON record fails the query, as does one whose values do not fit."""
    record = as_struct(schema)
    return _fields(one_record(text, _read_as(record)), record, optional)
