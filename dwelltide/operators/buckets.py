"""Balanced assignment of ids to N buckets.

The ids in order are dealt to the buckets in contiguous blocks whose sizes differ by at most
one, the larger blocks first. Of an id listed more than once the last place counts. Ids that
are not in the list get a bucket from their hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwelltide.session import shared_folder


def block_bucket(position: str, total: str, buckets: int) -> Column:
    """Bucket of a zero-based position among ``total``."""
    return F.expr(
        f"""CASE WHEN {position} < ({total} % {buckets}) * ({total} div {buckets} + 1)
                 THEN {position} div ({total} div {buckets} + 1)
                 ELSE {total} % {buckets}
                      + ({position} - ({total} % {buckets}) * ({total} div {buckets} + 1))
                        div ({total} div {buckets})
            END"""
    ).cast("int")


def hash_bucket(id_col: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int")


def assign_buckets(
    ids: DataFrame, id_col: str, buckets: int, order_by: list[str] | None = None
) -> DataFrame:
    """``(id, bucket)``, one row per distinct id.

    Positions come from a range partitioning: copies are counted first, so that ranges are
    even whatever the ids; each range is numbered on its own and starts after the rows of
    the ranges before it. The ranges are checkpointed, because the number of a range must
    not change when a task is run again.
    """
    if buckets < 1:
        raise ValueError("need at least one bucket")
    shared_folder(ids.sparkSession)
    order = [*(order_by or []), *([] if id_col in (order_by or []) else [id_col])]
    copies = ids.groupBy(*order).agg(F.count(F.lit(1)).alias("copies"))
    ranges = (
        copies.repartitionByRange(*order)
        .withColumn("range", F.spark_partition_id())
        .checkpoint()
    )
    # One row per range: as many as there are shuffle partitions.
    sizes = ranges.groupBy("range").agg(F.sum("copies").alias("size"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "range",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"),
        F.sum("size").over(Window.partitionBy()).alias("total"),
    )
    inside = (
        Window.partitionBy("range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = ranges.join(F.broadcast(offsets), "range").select(
        id_col, "total", (F.col("offset") + F.sum("copies").over(inside) - 1).alias("position")
    )
    if order_by:
        placed = placed.groupBy(id_col, "total").agg(F.max("position").alias("position"))
    return placed.select(id_col, block_bucket("position", "total", buckets).alias("bucket"))


def find_buckets(
    wanted: DataFrame, assigned: DataFrame, id_col: str, buckets: int
) -> DataFrame:
    """``(id, bucket)`` for each distinct wanted id, assigned or not.

    Both sides hold an id once, so no id is heavier than another in the join.
    """
    distinct = wanted.select(F.col(id_col).alias("wanted_id")).distinct()
    return distinct.join(
        assigned, F.col("wanted_id").eqNullSafe(F.col(id_col)), "left"
    ).select(
        F.col("wanted_id").alias(id_col),
        F.coalesce("bucket", hash_bucket("wanted_id", buckets)).alias("bucket"),
    )
