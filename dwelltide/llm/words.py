"""Words as the operators count them: runs of anything but ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Words of a text as a long; a null text has none."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(words(text))).cast("long")
