"""Record sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwelltide.functions.payload import MAX_RECORD_BYTES, is_oversized


def oversized_records(
    records: DataFrame, payload: str, limit: int = MAX_RECORD_BYTES
) -> DataFrame:
    """Records whose payload exceeds the limit, with their size."""
    return records.filter(is_oversized(payload, limit)).withColumn(
        "n_bytes", F.octet_length(payload)
    )
