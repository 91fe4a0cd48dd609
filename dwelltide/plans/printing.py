"""Jobs that print streams as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from dwelltide.functions.proto_json import proto_json
from dwelltide.operators.project import client_versions


def start_print(
    rows: DataFrame, name: str, folder: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Rows to the console, or to files below ``folder`` if one is given."""
    writer = rows.writeStream.queryName(name).outputMode("append")
    if folder is None:
        writer = writer.format("console").option("truncate", "false")
    else:
        writer = (
            writer.format("parquet")
            .option("path", f"{folder}/{name}")
            .option("checkpointLocation", f"{folder}/checkpoint/{name}")
        )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_client_and_event_print(
    client_logs: DataFrame, raw_events: DataFrame, **how
) -> tuple[StreamingQuery, StreamingQuery]:
    """Two independent streams in one job: client versions, and raw events as JSON."""
    events = raw_events.select(proto_json(raw_events).alias("value"))
    return (
        start_print(client_versions(client_logs), "client_versions", **how),
        start_print(events, "raw_events", **how),
    )


def start_text_print(lines: DataFrame, **how) -> StreamingQuery:
    return start_print(lines, "lines", **how)


def await_any(spark: SparkSession, timeout: int | None = None) -> None:
    """Until one of the job's queries ends or fails."""
    spark.streams.awaitAnyTermination(timeout)
