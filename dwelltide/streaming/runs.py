"""Runs: a checkpoint is a run, and its micro-batches are numbered after those of earlier ones.

A new checkpoint counts its micro-batches from 0 again. Numbers of its run are greater than all
that were written before it began, so it replaces no record and hides no row of an earlier one.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

#: Micro-batches of a run: more than any will have.
RUN_SPAN = 1 << 29
#: Runs are numbered from here on, so that numbers of their micro-batches fit into a long.
FIRST_RUN_AT = 1_600_000_000


def batch_number(run: int, batch_id: int) -> int:
    return run * RUN_SPAN + batch_id


def run_of(spark: SparkSession, checkpoint: str, kind: str) -> int:
    """The run of a checkpoint: tenths of a second till its first start, kept inside it. One that
    another kind of job has begun is refused."""
    folder = f"{checkpoint.rstrip('/')}/run"
    try:
        known = spark.read.schema("run bigint, kind string").parquet(folder).first()
    except AnalysisException:
        known = None
    if known is None:
        run = int((time.time() - FIRST_RUN_AT) * 10)
        spark.createDataFrame([(run, kind)], "run bigint, kind string").coalesce(1).write.mode("overwrite").parquet(folder)
        return run
    if known["kind"] != kind:
        raise ValueError(f"{checkpoint} belongs to another job: {known['kind']}")
    return known["run"]
