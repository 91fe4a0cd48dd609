"""Sinks of a stream: the record log, the keyed feature table, and both at once.

A micro-batch of the log is a folder of its own, and one of the table replaces the hash buckets
that it touches, so running a micro-batch again changes nothing. Micro-batches are numbered by
run and batch, see ``runs``, so a new checkpoint replaces nothing either.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwelltide.functions.payload import (
    MAX_RECORD_BYTES,
    decode_payload,
    is_oversized,
    to_records,
)
from dwelltide.operators.latest import newest_per_key
from dwelltide.sources.decode import as_struct
from dwelltide.streaming.keyed import BucketedRows
from dwelltide.streaming.runs import batch_number

# Records, and bytes of payload, that are put at once.
PUT_RECORDS = 500
PUT_BYTES = 5 * 1024 * 1024

LOG_SCHEMA = (
    "partition_key string, payload binary, writer int, put bigint, batch_id bigint, oversized boolean"
)


#: Bytes of records that a writer of a large batch takes, about.
WRITER_BYTES = 64 * 1024 * 1024


def writers_for(size: int) -> int:
    """How many writers share records of ``size`` bytes, so that none has more to sort as these grow."""
    return max(1, -(-size // WRITER_BYTES))


def put_batches(
    records: DataFrame, payload: str = "payload", max_records: int = PUT_RECORDS, max_bytes: int = PUT_BYTES
) -> DataFrame:
    """``records`` with ``writer``, their partition, and ``put``, the batch of it in which they are put.

    A batch is closed when the next record would be one too many, or would make its payloads
    too many bytes, and then holds at least one. Records keep their partitions and order; a
    null payload has no bytes. The sums restart where a batch does, which no window function can, so
    this goes through Arrow, batch by batch, and looks at lengths only.
    """
    if max_records < 1 or max_bytes < 1:
        raise ValueError("a batch holds at least one record and one byte")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        writer, put, held, size = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            count = batch.num_rows
            lengths = pc.fill_null(pc.binary_length(batch.column(payload)), 0)
            sums = np.append(0, np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64)))
            puts, at = np.zeros(count, dtype=np.int64), 0
            while at < count:
                fits = int(np.searchsorted(sums, sums[at] + max_bytes - size, side="right")) - 1
                end = min(max(fits, at), at + max_records - held, count)
                if end == at and not held:
                    end = at + 1  # larger than a batch by itself
                puts[at:end] = put
                held, size, at = held + end - at, size + int(sums[end] - sums[at]), end
                if at < count:
                    put, held, size = put + 1, 0, 0
            columns = [*batch.columns, pa.array(np.full(count, writer, dtype=np.int32)), pa.array(puts)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "writer", "put"])

    more = [T.StructField("writer", T.IntegerType()), T.StructField("put", T.LongType())]
    return records.mapInArrow(run, T.StructType([*records.schema.fields, *more]))


def write_log_batch(
    rows: DataFrame,
    batch_id: int,
    path: str,
    key_columns: Sequence[str] | None = None,
    max_bytes: int = MAX_RECORD_BYTES,
    options: Mapping[str, str] | None = None,
    writers: int | None = None,
    run: int = 0,
    encoder: Callable[[Sequence[str]], Column] | None = None,
    key: Callable[[Sequence[str]], Column] | None = None,
    put_records: int = PUT_RECORDS,
    put_bytes: int = PUT_BYTES,
) -> None:
    """Rows as records of one micro-batch; oversized ones into a partition of their own.

    A stateful stream has as many partitions as its state; ``writers`` limits the files, each of which is
    one task's work: ``writers_for`` gives a number for batches of any size. The others
    are numbered as they would be put, by at most ``put_records`` records and ``put_bytes`` bytes.
    """
    records = to_records(rows, key_columns, encoder, key)
    if writers:
        records = records.repartition(writers, "partition_key")
    # In an order of their own, so that a micro-batch run again is put alike.
    records = records.sortWithinPartitions("partition_key", "payload")
    oversized = is_oversized("payload", max_bytes)
    # What goes to quarantine is put nowhere, and takes no room.
    room = records.withColumn("room", F.when(~oversized, F.col("payload")))
    numbered = put_batches(room, "room", put_records, put_bytes).drop("room")
    marked = numbered.withColumn("oversized", oversized).withColumn("put", F.when(~F.col("oversized"), F.col("put")))
    writer = marked.write.mode("overwrite").options(**(options or {}))
    writer.partitionBy("oversized").parquet(f"{path}/batch_id={batch_number(run, batch_id)}")


def read_log(spark: SparkSession, path: str, oversized: bool = False) -> DataFrame:
    """Records of the log, or the quarantined ones."""
    log = spark.read.schema(LOG_SCHEMA).parquet(path)
    return log.filter(F.col("oversized") == oversized).drop("oversized")


def decode_log(records: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Rows of the log's records, with the micro-batch that wrote them."""
    return records.select(
        "batch_id", decode_payload("payload", as_struct(schema)).alias("row")
    ).select("batch_id", "row.*")


@dataclass(frozen=True)
class FeatureTable:
    """A keyed table: the newest row per key, in hash buckets of the first key.

    A micro-batch is merged with the buckets that it touches, and these are written anew; so a
    write costs what they hold, and a read is of plain files. Rows with ``deleted`` true remove
    their key.
    """

    path: str
    schema: T.StructType | str
    keys: Sequence[str] = ("device_id", "session_start")
    order: Sequence[str] = ("last_recv_ts",)
    deleted: str = "absorbed"
    buckets: int = 256

    @property
    def _rows(self) -> BucketedRows:
        kept = [f for f in as_struct(self.schema).fields if f.name != self.deleted]
        return BucketedRows(self.path, T.StructType(kept), self.keys[0], self.buckets)

    def write_batch(self, rows: DataFrame, number: int) -> None:
        """Merges a micro-batch; done again, it is the same."""
        spark, held = rows.sparkSession, self._rows
        state = held.state(spark, before=number)
        columns = as_struct(self.schema).fieldNames()
        newest = newest_per_key(rows.select(*columns), self.keys, self.order).persist()
        # One number per bucket, however many rows there are.
        found = newest.select(held.bucket(F.col(self.keys[0])).alias("bucket")).distinct().collect()
        touched = sorted(r["bucket"] for r in found)
        merged = newest.filter(~F.coalesce(self.deleted, F.lit(False))).drop(self.deleted)
        if state.generations.keys() & set(touched):
            before = held.read(spark, state, touched)
            same = [before[k].eqNullSafe(F.col(f"changed_{k}")) for k in self.keys]
            changed = newest.select(*[F.col(k).alias(f"changed_{k}") for k in self.keys])
            merged = before.join(changed, same, "left_anti").unionByName(merged)
        held.replace(spark, state, touched, merged, number)
        newest.unpersist()

    def latest(self, spark: SparkSession) -> DataFrame:
        """The newest row of each key, without deleted keys."""
        return self._rows.read(spark, self._rows.state(spark))

    def lookup(self, spark: SparkSession, *values) -> DataFrame:
        """The newest rows of some values of the first key: reads their buckets only."""
        held, kind = self._rows, as_struct(self.schema)[self.keys[0]].dataType
        if not values:
            return held.read(spark, held.state(spark), ())
        wanted = [F.lit(v).cast(kind) for v in values]
        buckets = spark.range(1).select(*[held.bucket(v) for v in wanted]).first()
        rows = held.read(spark, held.state(spark), set(buckets))
        return rows.filter(reduce(lambda a, b: a | b, [F.col(self.keys[0]).eqNullSafe(v) for v in wanted]))


@dataclass(frozen=True)
class FeatureSinks:
    """One stream into table and log: a ``foreachBatch`` function.

    The result of the micro-batch is computed once, into a folder that the next one replaces, and
    both sinks are written from there. Nothing is held in executor memory that a lost executor
    would take with it. ``run`` numbers the checkpoint.
    """

    table: FeatureTable
    log: Callable[[DataFrame, int], None] | None = None
    run: int = 0

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark, folder = rows.sparkSession, f"{self.table.path}/arrived"
        rows.select(*as_struct(self.table.schema).fieldNames()).write.mode("overwrite").parquet(folder)
        arrived = spark.read.schema(as_struct(self.table.schema)).parquet(folder)
        number = batch_number(self.run, batch_id)
        if not self.log:
            self.table.write_batch(arrived, number)
            return
        # Side by side: most of a small micro-batch's time is spent between its jobs.
        with ThreadPoolExecutor(max_workers=1) as beside:
            logged = beside.submit(inheritable_thread_target(spark)(self.log), arrived, batch_id)
            self.table.write_batch(arrived, number)
            logged.result()


