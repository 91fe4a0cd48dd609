"""Session measures: what is accumulated per session.

Every measure is associative and independent of row order, because sessions are built from
partial results and merge. One list of measures serves the batch operators (as Spark
aggregates) and the stateful stream (as a row of slots per session).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A newest value is aggregated as one decimal, event_time * 2^64 + (value + 2^63): its maximum
# is the value at the latest time, ties going to the greater value. A struct would order the
# same way, but Spark has no hash aggregation for struct buffers and would sort all rows.
_SPAN = f"{2**64}BD"
_SHIFT = f"{2**63}BD"


def newest_code(event_time: str, value: str) -> Column:
    """(event time, value) as one ordered decimal; null where the value is null."""
    return F.expr(
        f"cast(cast({event_time} as decimal(18,0)) * {_SPAN}"
        f" + cast({value} as decimal(19,0)) + {_SHIFT} as decimal(38,0))"
    )


def newest_value(code: str) -> Column:
    return F.expr(f"cast(pmod({code}, {_SPAN}) - {_SHIFT} as bigint)")


WHOLE, FRACTIONAL = "bigint", "double"


@dataclass(frozen=True)
class Measure:
    """``kind`` is sum, count, min, max or latest. ``type`` is that of the values: whole
    numbers, or doubles for a column of a fractional type; ``typed`` sets it."""

    name: str
    kind: str
    column: str | None = None
    type: str = WHOLE

    def __post_init__(self) -> None:
        if self.kind not in ("sum", "count", "min", "max", "latest"):
            raise ValueError(f"unknown kind of measure: {self.kind!r}")
        if self.column is None and self.kind != "count":
            raise ValueError(f"measure {self.name!r} needs a column")

    def partial(self, event_time: str) -> Column:
        """Aggregate of input rows."""
        if self.kind == "count":
            column = F.count(F.lit(1) if self.column is None else F.col(self.column))
        elif self.kind == "latest" and self.type == WHOLE:
            column = F.max(newest_code(event_time, self.column))
        elif self.kind == "latest":
            value = F.col(self.column).cast(self.type)
            stamped = F.struct(F.col(event_time).alias("at"), value.alias("value"))
            column = F.max(F.when(value.isNotNull(), stamped))
        else:
            column = getattr(F, self.kind)(F.col(self.column).cast(self.type))
        return column.alias(self.name)

    def merge(self) -> Column:
        """Aggregate of partial results."""
        combine = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "latest": F.max}
        return combine[self.kind](self.name)

    def finish(self) -> Column:
        column = F.col(self.name)
        if self.kind == "latest":
            column = newest_value(self.name) if self.type == WHOLE else column["value"]
        return column.alias(self.name)


@dataclass(frozen=True)
class Accumulator:
    """A result of one's own, made of measures: they start empty, take rows and merge, and
    ``result`` makes one column of theirs, in the order given. Average view time:

        Accumulator("mean", (Measure("s", "sum", "view_time"), Measure("n", "count")),
                    lambda s, n: s / n)
    """

    name: str
    parts: tuple[Measure, ...]
    result: Callable[..., Column]

    def measures(self) -> list[Measure]:
        return [replace(m, name=f"{self.name}__{m.name}") for m in self.parts]


@dataclass(frozen=True)
class Merged:
    """An accumulator with a merge of one's own: aggregate functions of Spark over rows and over
    its own buffers, a sketch's for one. ``add`` makes a buffer of rows, ``combine`` one of buffers,
    ``result`` the value that is shown. Distinct values, about:

        Merged("kinds", lambda: F.hll_sketch_agg("kind"), F.hll_union_agg, F.hll_sketch_estimate)

    The batch operators and the open sessions kept as a table have it; the keyed state, whose
    merges run in Python, has not.
    """

    name: str
    add: Callable[[], Column]
    combine: Callable[[Column], Column]
    result: Callable[[Column], Column]

    def partial(self, event_time: str) -> Column:
        return self.add().alias(self.name)

    def merge(self) -> Column:
        return self.combine(F.col(self.name))

    def finish(self) -> Column:
        return self.result(F.col(self.name)).alias(self.name)


def distinct_count(name: str, column: str, bits: int = 12) -> Merged:
    """About how many values a column has: a HyperLogLog sketch of 2^``bits`` registers, whose
    error is 1.04 / 2^(bits/2) (1.6 % by default). Nulls are no value."""
    return Merged(
        name,
        lambda: F.hll_sketch_agg(column, bits),
        lambda buffers: F.hll_union_agg(buffers, True),
        F.hll_sketch_estimate,
    )


def quantiles(name: str, column: str, ranks: Sequence[float], k: int = 200) -> Merged:
    """Values of a whole-number column at some ranks: a KLL sketch, whose rank error is about
    2.296 / k^0.9021 (1.9 % at ``k`` 200)."""
    return Merged(
        name,
        lambda: F.kll_sketch_agg_bigint(F.col(column).cast(WHOLE), k),
        lambda buffers: F.kll_merge_agg_bigint(buffers, k),
        lambda buffer: F.array(*[F.kll_sketch_get_quantile_bigint(buffer, F.lit(r)) for r in ranks]),
    )


def with_results(features: DataFrame, measures: Sequence[Measure | Accumulator | Merged]) -> DataFrame:
    """Accumulators' columns in place of those of their parts; the others stay as they are."""
    own = {a.name: a for a in measures if isinstance(a, Accumulator)}
    if not own:
        return features
    parts = {m.name: a.name for a in own.values() for m in a.measures()}
    columns = []
    for name in features.columns:
        if name not in parts:
            columns.append(F.col(name))
        elif (a := own.pop(parts[name], None)) is not None:
            columns.append(a.result(*[F.col(m.name) for m in a.measures()]).alias(a.name))
    return features.select(*columns)


def typed(
    measures: Sequence[Measure | Accumulator | Merged], schema: T.StructType
) -> tuple[Measure | Merged, ...]:
    """The measures with the types of their columns, accumulators as their parts; batch and
    stream then compute alike.

    Doubles and floats are measured as doubles. A column that holds neither these nor whole
    numbers of up to 64 bits is refused, rather than rounded.
    """
    found = []
    for m in [m for a in measures for m in (a.measures() if isinstance(a, Accumulator) else [a])]:
        if isinstance(m, Merged):
            found.append(m)
            continue
        kind = None if m.kind == "count" else schema[m.column].dataType
        if kind is None:
            found.append(m)
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            found.append(replace(m, type=WHOLE))
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            found.append(replace(m, type=FRACTIONAL))
        else:
            raise ValueError(f"measure {m.name!r}: cannot measure a column of {kind.simpleString()}")
    return tuple(found)


DEFAULT_MEASURES = (
    Measure("cvt_total", "sum", "view_time"),
    Measure("n_views", "count"),
    Measure("last_view_time", "latest", "view_time"),
)
