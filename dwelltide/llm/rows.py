"""Whole rows, whatever their columns are called and hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column's name as an expression: dots and backticks in it are part of the name."""
    return f"`{name.replace('`', '``')}`"


def columns(docs: DataFrame) -> list[Column]:
    return [F.col(quoted(name)) for name in docs.columns]


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns; types that have none are hashed as their JSON text."""
    parts = []
    for name, kind in docs.dtypes:
        column = F.col(quoted(name))
        if kind.startswith(("array", "map", "struct", "variant")):
            column = F.to_json(F.struct(column), {"ignoreNullFields": "false"})
        parts += [column.isNull(), column]
    return F.xxhash64(*parts)


def carried(docs: DataFrame, *used: Column) -> DataFrame:
    """``row``, the whole row as one column, beside the columns that an operator reads. What it
    adds then clashes with none of the row's."""
    return docs.select(F.struct(*columns(docs)).alias("row"), *used)


def unpacked(docs: DataFrame, names: list[str], **changed: Column) -> DataFrame:
    """The rows again, with some columns changed, as far as they have these."""
    return docs.select(
        *((changed[n] if n in changed else F.col(f"row.{quoted(n)}")).alias(n) for n in names)
    )
