"""Metrics that a query carries along, and where they go."""

from __future__ import annotations

import base64
import json
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from dwelltide.functions.clock import lag_seconds

# Upper bounds of the latency histogram, in seconds.
LAG_BOUNDS = (1, 5, 30, 60, 300, 1800, 7200)
#: Size of the sketch of latencies: percentiles are right to about 2.296 / 400^0.9021, a rank of 1 %.
LAG_SKETCH = 400


def latency_measures(event_ms: str = "recv_timestamp", now_ms: int | None = None) -> list[Column]:
    """Aggregates that describe the distribution of ingest latency, in seconds."""
    lag = lag_seconds(event_ms, now_ms)
    return [
        F.count(lag).alias("n"),
        F.min(lag).alias("min_s"),
        F.max(lag).alias("max_s"),
        F.avg(lag).alias("avg_s"),
        F.percentile_approx(lag, [0.5, 0.95, 0.99]).alias("percentiles_s"),
        *[F.count_if(lag <= bound).alias(f"le_{bound}_s") for bound in LAG_BOUNDS],
        F.kll_sketch_agg_bigint(lag, LAG_SKETCH).alias("sketch"),
    ]


def observe_latency(
    rows: DataFrame,
    name: str | Observation = "latency",
    now_ms: int | None = None,
    event_ms: str = "recv_timestamp",
) -> DataFrame:
    """The same rows, with the distribution of their ingest latency as a metric."""
    return rows.observe(name, *latency_measures(event_ms, now_ms))


def observe_emitted(results: DataFrame, name: str = "emitted") -> DataFrame:
    """The same rows, results counted per micro-batch; markers of absorbed sessions apart."""
    if "absorbed" not in results.columns:
        return results.observe(name, F.count(F.lit(1)).alias("n"))
    return results.observe(
        name,
        F.count_if(~F.col("absorbed")).alias("n"),
        F.count_if("closed").alias("closed"),
        F.count_if("absorbed").alias("absorbed"),
    )


class MetricsListener(StreamingQueryListener):
    """Hands each micro-batch's metrics and progress to a function."""

    def __init__(self, report: Callable[[dict], None]) -> None:
        self.report = report

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        metrics = event.progress.observedMetrics or {}
        self.report(
            {
                "query": progress["name"],
                "batch_id": progress["batchId"],
                "input_rows": progress["numInputRows"],
                "rows_per_second": float(progress.get("processedRowsPerSecond") or 0),
                "watermark": progress.get("eventTime", {}).get("watermark"),
                "state": [
                    {
                        "rows": operator["numRowsTotal"],
                        "bytes": operator["memoryUsedBytes"],
                        "late_rows": operator["numRowsDroppedByWatermark"],
                    }
                    for operator in progress.get("stateOperators", [])
                ],
                **{name: row.asDict(recursive=True) for name, row in metrics.items()},
            }
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def report_metrics(spark: SparkSession, report: Callable[[dict], None]) -> MetricsListener:
    """Starts reporting; remove the listener from ``spark.streams`` to stop."""
    listener = MetricsListener(report)
    spark.streams.addListener(listener)
    return listener


METRICS_SCHEMA = (
    "query string, batch_id bigint, input_rows bigint, rows_per_second double, "
    "watermark string, state string, metrics map<string, string>"
)


def _as_text(value: bytes | bytearray) -> str:
    return base64.b64encode(bytes(value)).decode()


def latency_over(reports: DataFrame, *by: Column, metric: str = "latency", ranks=(0.5, 0.95, 0.99)) -> DataFrame:
    """Latencies of all micro-batches of a metrics table together, or per value of ``by``: ``n``,
    ``min_s``, ``max_s`` and ``percentiles_s``, merged from the sketches that they left. Filter the table
    for a period."""
    held = F.from_json(F.col("metrics")[metric], "n bigint, min_s bigint, max_s bigint, sketch string")
    rows = reports.select(*by, held.alias("held")).filter("held.n > 0")
    names = rows.columns[:-1]
    sketch = F.kll_merge_agg_bigint(F.unbase64("held.sketch"), LAG_SKETCH)
    merged = rows.groupBy(*names).agg(
        F.sum("held.n").alias("n"), F.min("held.min_s").alias("min_s"), F.max("held.max_s").alias("max_s"), sketch.alias("sketch")
    )
    quantiles = F.array(*[F.kll_sketch_get_quantile_bigint("sketch", F.lit(r)) for r in ranks])
    return merged.filter("n > 0").withColumn("percentiles_s", quantiles).drop("sketch")


class MetricsTable:
    """Keeps one job's reports as rows of a table, written a number at a time; a process that dies
    loses those that wait, so by default none does."""

    def __init__(self, spark: SparkSession, path: str, every: int = 1) -> None:
        self.spark, self.path, self.every = spark, path, every
        self.waiting: list[tuple] = []
        self.writing = threading.Lock()  # two writes at once would undo each other

    def __call__(self, report: dict) -> None:
        known = ("query", "batch_id", "input_rows", "rows_per_second", "watermark")
        observed = {k: json.dumps(v, default=_as_text) for k, v in report.items() if k not in (*known, "state")}
        self.waiting.append((*[report[k] for k in known], json.dumps(report["state"]), observed))
        if len(self.waiting) >= self.every:
            self.flush()

    def flush(self) -> None:
        """Writes what waits. Reports whose write fails wait on, for the next one."""
        with self.writing:
            rows = list(self.waiting)
            if rows:
                frame = self.spark.createDataFrame(rows, METRICS_SCHEMA)
                frame.coalesce(1).write.mode("append").parquet(self.path)
                del self.waiting[: len(rows)]


@contextmanager
def metrics_table(spark: SparkSession, path: str, every: int = 1) -> Iterator[MetricsTable]:
    """Reports of all streams go to a table while the block runs; what waits is written at
    its end, after the reports still on their way have come in."""
    table = MetricsTable(spark, path, every)
    listener = report_metrics(spark, table)
    try:
        yield table
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(listener)
        table.flush()
