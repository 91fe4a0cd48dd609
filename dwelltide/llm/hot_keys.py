"""Looking values up by key where one key may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key that one task of a join may take; also the most keys that are sent to all
#: executors, since no more than ``rows / limit`` keys can hold more than ``limit`` rows.
KEY_ROWS = 100_000


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    uses: str,
    total: int,
    spread: Sequence[str],
) -> DataFrame:
    """``rows`` with the ``values`` that ``table`` has for their ``keys``, null where it has none.

    ``table`` has one row per key; its column ``uses`` says about how many of the ``total``
    rows ask for it. Keys of many uses are sent to all executors: at most ``KEY_ROWS`` of them,
    by that count. Their rows take no part in the join that answers the others: they stand
    there under a hash of the columns ``spread``, so they meet in no task.
    """
    limit = max(KEY_ROWS, -(-total // KEY_ROWS))
    named = table.select(
        *(F.col(k).alias(f"t_{k}") for k in keys),
        *(F.col(v).alias(f"t_{v}") for v in values),
        F.col(uses).alias("t_uses"),
    )
    hot = named.filter(F.col("t_uses") > limit)
    hot = hot.select(
        *(F.col(f"t_{k}").alias(f"h_{k}") for k in keys),
        *(F.col(f"t_{v}").alias(f"h_{v}") for v in values),
        F.lit(True).alias("is_hot"),
    )
    cold = named.filter(F.col("t_uses") <= limit).drop("t_uses").withColumn("t_lane", F.lit(0).cast("long"))
    hit = F.lit(True)
    for k in keys:
        hit = hit & (F.col(k) == F.col(f"h_{k}"))
    found = rows.join(F.broadcast(hot), hit, "left")
    # Uneven numbers only, so that none is the lane of the others.
    own = F.xxhash64(*spread).bitwiseOR(F.lit(1).cast("long"))
    lane = F.when(F.col("is_hot") | F.col(keys[0]).isNull(), own).otherwise(F.lit(0).cast("long"))
    found = found.withColumn("lane", lane)
    met = F.col("lane") == F.col("t_lane")
    for k in keys:
        met = met & (F.col(k) == F.col(f"t_{k}"))
    return found.join(cold, met, "left").select(
        *(F.col(f"`{c}`") for c in rows.columns),
        *(F.coalesce(f"h_{v}", f"t_{v}").alias(v) for v in values),
    )
