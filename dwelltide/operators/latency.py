"""Distribution of ingest latency over a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwelltide.functions.clock import lag_seconds


def latency_histogram(
    rows: DataFrame, now_ms: int, bucket_seconds: int, event_ms: str = "recv_timestamp"
) -> DataFrame:
    """Rows per latency bucket, the bucket truncated toward zero like the lag itself."""
    lag = lag_seconds(event_ms, now_ms).alias("lag")
    bucket = F.expr(f"(lag div {bucket_seconds}) * {bucket_seconds}").alias("lag_bucket")
    return rows.select(lag).groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
