"""The newest row or value per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwelltide.functions.measures import Measure, typed


def newest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole row that is greatest by ``order`` for each key.

    An aggregate rather than a ranking: copies of a key are reduced before the shuffle.
    """
    rest = [name for name in rows.columns if name not in keys]
    ranked = F.struct(*order, *[name for name in rest if name not in order])
    newest = rows.groupBy(*keys).agg(F.max(ranked).alias("newest"))
    return newest.select(*keys, *[F.col(f"newest.`{name}`").alias(name) for name in rest])


def latest_values(
    rows: DataFrame, value: str, key: str = "device_id", event_ms: str = "recv_timestamp"
) -> DataFrame:
    """Time and value of each key's latest row; of equal times, the greater value."""
    (latest,) = typed([Measure(f"last_{value}", "latest", value)], rows.schema)
    return (
        rows.groupBy(key)
        .agg(F.max(event_ms).alias("last_recv_ts"), latest.partial(event_ms))
        .select(key, "last_recv_ts", latest.finish())
    )
