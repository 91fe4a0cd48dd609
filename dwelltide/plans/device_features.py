"""Session features per device, from the flat event stream to log and table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dwelltide.functions.measures import DEFAULT_MEASURES, Accumulator, Measure, Merged
from dwelltide.operators.project import device_input, view_input, viewed, with_event_time
from dwelltide.operators.sessions import session_features
from dwelltide.session import STATEFUL_SETTINGS, settings
from dwelltide.sources.decode import MALFORMED
from dwelltide.sources.streams import KeyFunction, Stream
from dwelltide.streaming.append import closed_sessions, merged_sessions
from dwelltide.streaming.early import early_sessions
from dwelltide.streaming.metrics import observe_emitted, observe_latency
from dwelltide.streaming.open_sessions import IDLE_AFTER, OpenSessions, with_ticks
from dwelltide.streaming.runs import run_of
from dwelltide.streaming.sinks import FeatureSinks, FeatureTable

# The job's session gap, lateness bound and interval of early results.
SESSION_GAP = "180 days"
LATENESS = "7200 seconds"
EARLY_EVERY = "5 seconds"

RECEIVED = "recv_timestamp"


@dataclass(frozen=True)
class JobFolders:
    """A job's own folders below a shared base."""

    base: str
    job_name: str

    def _folder(self, kind: str) -> str:
        return f"{self.base.rstrip('/')}/{self.job_name}/{kind}"

    @property
    def checkpoint(self) -> str:
        return self._folder("checkpoint")

    @property
    def table(self) -> str:
        return self._folder("table")

    @property
    def log(self) -> str:
        return self._folder("log")

    @property
    def open_sessions(self) -> str:
        return self._folder("open")

    @property
    def final(self) -> JobFolders:
        """The folders of the job of closed sessions, apart from those of early results."""
        return JobFolders(self.base, f"{self.job_name}/final")

    @property
    def quarantine(self) -> str:
        return self._folder("quarantine")

    @property
    def metrics(self) -> str:
        return self._folder("metrics")


def device_features(
    events: DataFrame,
    gap: int | str = SESSION_GAP,
    measures: Sequence[Measure | Accumulator] = DEFAULT_MEASURES,
) -> DataFrame:
    """The batch form: session features of a table of flat events."""
    return session_features(view_input(events), gap, measures=measures)


def timed_views(
    events: DataFrame,
    lateness: str = LATENESS,
    now_ms: int | None = None,
    event_ms: str | Column = RECEIVED,
) -> DataFrame:
    """Device input of a stream, rows with views only, latency observed. ``event_ms`` is the
    time that counts, a column or an expression; it stands as receive time from then on.

    The watermark comes first: rows without views advance event time too.
    """
    own = F.col(event_ms) if isinstance(event_ms, str) else event_ms
    timed = with_event_time(events.withColumn(RECEIVED, own), lateness)
    views = device_input(timed.filter(viewed("et")), "et")
    return observe_latency(views, now_ms=now_ms)


def running_features(
    events: DataFrame,
    gap: int | str = SESSION_GAP,
    lateness: str = LATENESS,
    measures: Sequence[Measure | Accumulator] = DEFAULT_MEASURES,
    event_ms: str | Column = RECEIVED,
) -> DataFrame:
    """The streaming form with early results, for output mode update."""
    views = timed_views(events, lateness, event_ms=event_ms)
    return observe_emitted(early_sessions(views, gap, measures=measures))


def final_features(
    events: DataFrame,
    gap: int | str = SESSION_GAP,
    lateness: str = LATENESS,
    measures: Sequence[Measure | Accumulator] = DEFAULT_MEASURES,
    event_ms: str | Column = RECEIVED,
    merge_late: bool = False,
) -> DataFrame:
    """The streaming form that emits a session once it has closed, for output mode append.
    ``merge_late`` keeps a row behind the limit if it touches an open session."""
    views = timed_views(events, lateness, event_ms=event_ms)
    sessions = merged_sessions if merge_late else closed_sessions
    return observe_emitted(sessions(views, gap, measures=measures))


def feature_table(features: DataFrame | T.StructType, path: str, buckets: int = 256) -> FeatureTable:
    """The table that takes the rows of ``running_features``, or of that schema."""
    schema = features.schema if isinstance(features, DataFrame) else features
    order = ("last_recv_ts", "n_views", "closed")
    present = [name for name in order if name in schema.fieldNames()]
    return FeatureTable(path, schema, order=present, buckets=buckets)


def _start(
    spark: SparkSession,
    features: DataFrame,
    mode: str,
    write: Callable[[DataFrame, int], None],
    folders: JobFolders,
    name: str,
    state_partitions: int | None,
    trigger: dict | None,
) -> StreamingQuery:
    stateful = dict(STATEFUL_SETTINGS)
    if state_partitions:
        stateful["spark.sql.shuffle.partitions"] = str(state_partitions)
    with settings(spark, stateful):
        return (
            features.writeStream.queryName(name)
            .outputMode(mode)
            .option("checkpointLocation", folders.checkpoint)
            .foreachBatch(write)
            .trigger(**(trigger or {"processingTime": EARLY_EVERY}))
            .start()
        )


def start_quarantine(
    spark: SparkSession,
    events: DataFrame,
    folders: JobFolders,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The texts that a quarantined source could not decode, kept in a folder of their own."""
    bad = events.filter(F.col(MALFORMED).isNotNull())
    return (
        bad.select(MALFORMED, F.current_timestamp().alias("seen_at"))
        .writeStream.queryName(f"{folders.job_name}-quarantine")
        .option("checkpointLocation", f"{folders.quarantine}_checkpoint")
        .trigger(**(trigger or {"processingTime": EARLY_EVERY}))
        .start(folders.quarantine, format="parquet", outputMode="append")
    )


def _well_formed(
    spark: SparkSession, events: DataFrame, folders: JobFolders, trigger: dict | None
) -> DataFrame:
    """The decoded events. Of a quarantined source the others go to their folder; a job that
    ends with the present input has them there before it starts itself."""
    if MALFORMED not in events.columns:
        return events
    query = start_quarantine(spark, events, folders, trigger)
    if trigger and "processingTime" not in trigger:
        query.awaitTermination()
    return events.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)


def _writers(spark: SparkSession, writers: int | None, state_partitions: int | None) -> int:
    """Files per micro-batch: by default one for every four state partitions."""
    partitions = state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return writers or max(1, partitions // 4)


def start_running(
    spark: SparkSession,
    events: DataFrame,
    folders: JobFolders,
    gap: int | str = SESSION_GAP,
    lateness: str = LATENESS,
    key_columns: Sequence[str] | None = ("device_id",),
    buckets: int = 256,
    writers: int | None = None,
    state_partitions: int | None = None,
    trigger: dict | None = None,
    measures: Sequence[Measure | Accumulator | Merged] = DEFAULT_MEASURES,
    event_ms: str | Column = RECEIVED,
    key: KeyFunction | None = None,
    state: str = "keyed",
    fire_every: str | None = None,
    source: str | None = None,
    sources: Sequence[str] = (),
    idle_after: str = IDLE_AFTER,
    clock: Callable[[], int] | None = None,
) -> StreamingQuery:
    """Early and final results into feature table and record log.

    ``state`` says where open sessions are: ``keyed`` in Spark's state store, where a micro-batch costs
    what it changes, or in a ``table``, where no row passes through Python but the buckets that
    a micro-batch touches are written anew. Only the table emits open sessions again without
    input (``fire_every``; not with a trigger that ends, as then the stream has no end), takes
    event time from the active ones of several ``sources``, and has measures that are ``Merged``.

    ``state_partitions`` is fixed when the job first starts; by default the session's
    number of shuffle partitions. A job that starts on a new checkpoint goes on in the same
    table and log, as their next run. What a quarantined source could not decode goes to the
    folder ``quarantine``. ``event_ms`` is the time column or an expression for it, ``key`` makes a
    record's key of the names in ``key_columns``.
    """
    writers = _writers(spark, writers, state_partitions)
    if state not in ("keyed", "table"):
        raise ValueError(f"open sessions are keyed or a table, not {state!r}")
    if state == "keyed" and (fire_every or source):
        raise ValueError("the keyed state fires on changes only and has one event time")
    if fire_every and trigger and "processingTime" not in trigger:
        raise ValueError("firing by the clock needs a trigger without an end")
    run = run_of(spark, folders.checkpoint, f"early results, {state}" + " in groups" * (state == "keyed"))
    events = _well_formed(spark, events, folders, trigger)
    name = folders.job_name
    log = Stream(folders.log, key_columns=key_columns, key=key).sink(run=run)
    if state == "keyed":
        features = running_features(events, gap, lateness, measures, event_ms)
        sinks = FeatureSinks(feature_table(features, folders.table, buckets), log, run)
        return _start(spark, features, "update", sinks, folders, name, state_partitions, trigger)
    own = F.col(event_ms) if isinstance(event_ms, str) else event_ms
    rows = events.withColumn(RECEIVED, own)
    how = {"source": source, "sources": sources, "idle_after": idle_after, "fire_every": fire_every}
    how |= {"clock": clock} if clock else {}
    sessions = OpenSessions(
        spark, folders.open_sessions, rows.schema, gap, lateness, measures=measures, counted=viewed(None),
        buckets=buckets, run=run, **how,
    )
    sessions.sink = FeatureSinks(feature_table(sessions.features_schema(spark), folders.table, buckets), log, run)
    observed = observe_latency(rows.withColumn("viewed_ms", F.when(viewed(None), F.col(RECEIVED))), event_ms="viewed_ms")
    rows = with_ticks(observed.drop("viewed_ms")) if fire_every else observed.drop("viewed_ms")
    return _start(spark, rows, "append", sessions, folders, name, state_partitions, trigger)


def start_final(
    spark: SparkSession,
    events: DataFrame,
    folders: JobFolders,
    gap: int | str = SESSION_GAP,
    lateness: str = LATENESS,
    key_columns: Sequence[str] | None = ("device_id",),
    writers: int | None = None,
    state_partitions: int | None = None,
    trigger: dict | None = None,
    measures: Sequence[Measure | Accumulator] = DEFAULT_MEASURES,
    event_ms: str | Column = RECEIVED,
    key: KeyFunction | None = None,
    merge_late: bool = False,
) -> StreamingQuery:
    """Closed sessions into a record log, with checkpoint and log in ``folders.final``."""
    writers = _writers(spark, writers, state_partitions)
    own = folders.final
    run = run_of(spark, own.checkpoint, "closed sessions" + ", late ones merged in groups" * merge_late)
    events = _well_formed(spark, events, own, trigger)
    features = final_features(events, gap, lateness, measures, event_ms, merge_late)
    log = Stream(own.log, key_columns=key_columns, key=key).sink(writers=writers, run=run)
    name = f"{folders.job_name}-final"
    return _start(spark, features, "append", log, own, name, state_partitions, trigger)
