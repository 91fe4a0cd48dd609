"""Rows in hash buckets, of which a micro-batch replaces those that it touches.

A bucket has two generations, folders that are written in turn by dynamic partition overwrite.
A small table beside them tells the generation of each bucket; it has two generations of
its own, is written last, and so finishes a micro-batch. One that is run again starts from
what the micro-batch before it left, and changes nothing. Readers have the time of one
micro-batch before the generation that they read is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwelltide.sources.decode import as_struct

_PLACES = "bucket int, generation int, least bigint, number bigint, mark string, half int"


@dataclass(frozen=True)
class State:
    """What a finished micro-batch left: generations of the buckets, a number of the writer's own for
    each, and a text of its own."""

    number: int = -1
    half: int = 1
    generations: dict[int, int] = field(default_factory=dict)
    least: dict[int, int | None] = field(default_factory=dict)
    mark: str | None = None


@dataclass(frozen=True)
class BucketedRows:
    """``key`` is the column whose hash names the bucket. The number of buckets stays as it is
    while the rows live; let a bucket be up to about a gigabyte."""

    path: str
    schema: T.StructType | str
    key: str
    buckets: int = 256

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _columns(self) -> T.StructType:
        # A filler keeps the folder of a bucket without rows.
        return T.StructType([*as_struct(self.schema).fields, T.StructField("filler", T.BooleanType())])

    def state(self, spark: SparkSession, before: int | None = None) -> State:
        """The newest state, or that before a micro-batch. One older than the newest has none any
        more, and is refused."""
        try:
            rows = spark.read.schema(_PLACES).parquet(f"{self.path}/places").collect()
        except AnalysisException:
            return State()
        if before is not None and any(r["number"] > before for r in rows):
            raise ValueError(f"{self.path} is past micro-batch {before} already")
        numbers = {r["number"]: r["half"] for r in rows if before is None or r["number"] < before}
        if not numbers:
            return State()
        newest = max(numbers)
        held = [r for r in rows if r["number"] == newest and r["half"] == numbers[newest]]
        generations = {r["bucket"]: r["generation"] for r in held if r["bucket"] is not None}
        least = {r["bucket"]: r["least"] for r in held if r["bucket"] is not None}
        return State(newest, numbers[newest], generations, least, held[0]["mark"])

    def read(self, spark: SparkSession, state: State, only: Iterable[int] | None = None) -> DataFrame:
        """The rows of some buckets, or of all, as a state has them."""
        wanted = sorted(state.generations if only is None else set(only) & set(state.generations))
        folders = [f"{self.path}/rows/bucket={b}/generation={state.generations[b]}" for b in wanted]
        if not folders:
            return spark.createDataFrame([], as_struct(self.schema))
        rows = spark.read.schema(self._columns()).parquet(*folders)
        return rows.filter("filler IS NULL").drop("filler")

    def replace(
        self,
        spark: SparkSession,
        state: State,
        touched: Sequence[int],
        rows: DataFrame,
        number: int,
        mark: str | None = None,
        least: Mapping[int, int | None] | None = None,
    ) -> State:
        """The rows of the touched buckets become ``rows``; others stay. ``state`` is the one
        before the micro-batch ``number``."""
        generations = {**state.generations, **{b: 1 - state.generations.get(b, 1) for b in touched}}
        if touched:
            fillers = spark.createDataFrame([(b, generations[b]) for b in touched], "bucket int, generation int")
            names = as_struct(self.schema).fieldNames()
            placed = rows.select(*names, F.lit(None).cast("boolean").alias("filler"), self.bucket(F.col(self.key)).alias("bucket"))
            placed = placed.repartition(max(1, len(touched)), "bucket").join(F.broadcast(fillers), "bucket")
            empty = fillers.select(
                *(F.lit(None).cast(f.dataType).alias(f.name) for f in as_struct(self.schema)),
                F.lit(True).alias("filler"), "bucket", "generation",
            )
            (
                placed.select(*names, "filler", "bucket", "generation")
                .unionByName(empty.coalesce(1))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("bucket", "generation")
                .parquet(f"{self.path}/rows")
            )
        own = {**state.least, **{b: (least or {}).get(b) for b in touched}}
        new = State(number, 1 - state.half, generations, own, mark)
        held = [(b, g, own.get(b), number, mark, new.half) for b, g in sorted(generations.items())]
        held = held or [(None, None, None, number, mark, new.half)]
        places = spark.createDataFrame(held, _PLACES).coalesce(1)
        writer = places.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("half").parquet(f"{self.path}/places")
        return new
