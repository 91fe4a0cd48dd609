"""Named streams and their options.

A stream is files of a columnar or text format, or a connector that yields a payload column
(``kinesis``, ``kafka`` and the like, whose package the cluster provides). Options given by
the caller always win over the stream's own. Credentials come from the environment.

Decoder, encoder and record key may be functions of columns, so that a cluster's own formats
(``from_protobuf``, ``from_avro``) plug in.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwelltide.functions.payload import MAX_RECORD_BYTES
from dwelltide.sources.decode import MALFORMED, as_struct, decode_binary, decode_json, decode_text
from dwelltide.streaming.sinks import write_log_batch

FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "binaryFile")

# What a connector calls the stream it reads, and where "latest" and "earliest" are.
CONNECTORS: dict[str, dict[str, str]] = {
    "kinesis": {"name": "streamName", "start": "startingposition", "latest": "LATEST", "earliest": "TRIM_HORIZON"},
    "kafka": {"name": "subscribe", "start": "startingOffsets", "latest": "latest", "earliest": "earliest"},
}

# Options of the dedicated-throughput consumer, passed to its connector.
CONNECTOR_DEFAULTS: dict[str, dict[str, str]] = {
    "kinesis": {
        "scan.stream.recordpublisher": "EFO",
        "scan.stream.efo.registration": "EAGER",
        "scan.stream.initpos": "LATEST",
    },
}

Decoder = Callable[[Column], Column]
KeyFunction = Callable[[Sequence[str]], Column]


@dataclass(frozen=True)
class Stream:
    """Where records are, how they are read, and how they are written back.

    ``decoder`` is None for formats whose rows are the records already, else ``text``,
    ``json`` or ``binary``, or a function from the payload column to a struct of the record's
    fields; a record it cannot read must fail there. ``encoder`` makes a record's bytes of the names of its
    columns, by default as JSON. ``key`` makes a written record's key of them, by default the hash of
    ``key_columns``, or of all columns. ``starting`` is ``latest`` or ``earliest``, for
    connectors that are told where to begin and for files by ``event_ms``: "latest" begins at the
    time the stream is first defined, with ``start_ms`` at that time.
    """

    location: str
    schema: T.StructType | str | None = None
    format: str = "parquet"
    decoder: str | Decoder | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    key_columns: Sequence[str] | None = None
    payload: str = "value"
    encoder: KeyFunction | None = None
    key: KeyFunction | None = None
    starting: str | None = None
    start_ms: int | None = None
    event_ms: str = "recv_timestamp"

    def all_options(self, overrides: Mapping[str, str] | None = None) -> dict[str, str]:
        own = dict(CONNECTOR_DEFAULTS.get(self.format, {}))
        if self.starting and self.format in CONNECTORS:
            connector = CONNECTORS[self.format]
            own[connector["start"]] = connector[self.starting]
        return {**own, **self.options, **(overrides or {})}

    def _checked(self, quarantine: bool) -> None:
        if self.decoder not in (None, "text", "json", "binary") and not callable(self.decoder):
            raise ValueError(f"unknown decoder {self.decoder!r} of stream {self.location!r}")
        if self.schema is None and self.decoder in (None, "json") and self.format != "text":
            raise ValueError(f"stream {self.location!r} needs a schema")
        if quarantine and self.decoder != "json":
            raise ValueError("only JSON payloads can be quarantined")
        if self.starting not in (None, "latest", "earliest"):
            raise ValueError(f"start at latest or earliest, not at {self.starting!r}")

    def _load(self, reader, overrides: Mapping[str, str] | None, quarantine: bool) -> DataFrame:
        self._checked(quarantine)
        reader = reader.format(self.format).options(**self.all_options(overrides))
        if self.decoder is None and self.schema is not None:
            reader = reader.schema(as_struct(self.schema))
        elif self.format in ("parquet", "orc", "json"):
            reader = reader.schema(f"{self.payload} binary")
        if self.format in FILE_FORMATS:
            rows = reader.load(self.location)
        else:
            named = CONNECTORS.get(self.format, {}).get("name", "streamName")
            rows = reader.option(named, self.location).load()
        return self._from(self._decoded(rows, quarantine))

    def _decoded(self, rows: DataFrame, quarantine: bool) -> DataFrame:
        if callable(self.decoder):
            return rows.select(self.decoder(F.col(self.payload)).alias("record")).select("record.*")
        if self.decoder == "text":
            return decode_text(rows, self.payload)
        if self.decoder == "binary":
            return decode_binary(rows, self.payload)
        if self.decoder == "json":
            return decode_json(rows, self.schema, self.payload, quarantine)
        return rows

    def _from(self, rows: DataFrame) -> DataFrame:
        """Files know no position: "latest" is a time there."""
        if self.starting != "latest" or self.format not in FILE_FORMATS:
            return rows
        now = int(time.time() * 1000) if self.start_ms is None else self.start_ms
        recent = F.col(self.event_ms) >= now
        if MALFORMED in rows.columns:
            recent = recent | F.col(MALFORMED).isNotNull()
        return rows.filter(recent)

    def source(
        self,
        spark: SparkSession,
        overrides: Mapping[str, str] | None = None,
        quarantine: bool = False,
    ) -> DataFrame:
        """The stream as it grows; it has no end of its own."""
        return self._load(spark.readStream, overrides, quarantine)

    def table(
        self,
        spark: SparkSession,
        overrides: Mapping[str, str] | None = None,
        quarantine: bool = False,
    ) -> DataFrame:
        """The records present now."""
        return self._load(spark.read, overrides, quarantine)

    def sink(
        self,
        overrides: Mapping[str, str] | None = None,
        max_bytes: int = MAX_RECORD_BYTES,
        writers: int | None = None,
        run: int = 0,
    ) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function that appends rows, encoded, to the stream's log. ``run``
        numbers the checkpoint of the stream that feeds it."""
        if self.format != "parquet":
            raise ValueError(f"records are written as parquet files, not {self.format!r}")

        def write(rows: DataFrame, batch_id: int) -> None:
            write_log_batch(
                rows,
                batch_id,
                self.location,
                self.key_columns,
                max_bytes,
                self.all_options(overrides),
                writers,
                run,
                self.encoder,
                self.key,
            )

        return write

    def with_options(self, **options: str) -> Stream:
        return replace(self, options={**self.options, **options})


FLAT_EVENT = "device_id string, view_time int, recv_timestamp bigint"
CLIENT_LOG = "platform string, version string"

# Named streams, with the schema where it is fixed.
PRESETS: dict[str, str | None] = {
    "raw": None,
    "rich": None,
    "flat": FLAT_EVENT,
    "client_log": CLIENT_LOG,
}


def preset(
    name: str,
    base: str,
    schema: T.StructType | str | None = None,
    **fields,
) -> Stream:
    """A named stream below ``base``. Raw and rich events take the caller's schema."""
    if name not in PRESETS:
        raise KeyError(f"no stream named {name!r}; there are {', '.join(PRESETS)}")
    schema = schema or PRESETS[name]
    if schema is None:
        raise ValueError(f"stream {name!r} needs a schema")
    return Stream(f"{base.rstrip('/')}/{name}", schema, **fields)


def text_stream(location: str, **fields) -> Stream:
    """Lines of text files, one record each."""
    return Stream(location, "value string", format="text", **fields)


def from_latest(rows: DataFrame, start_ms: int, event_ms: str = "recv_timestamp") -> DataFrame:
    """Records received at ``start_ms`` or later: the start position "latest" for files.

    Applied before the watermark and pushed into the scan; a connector has an option
    instead.
    """
    return rows.filter(F.col(event_ms) >= start_ms)
