"""Web archives, index first.

Tasks write WARC records, each a gzip member of its own, and return an index: file, offset, length,
URL and digest of every record. Records are then chosen on the index, and reading takes only
the chosen ones' byte ranges, sorted by place and coalesced where they lie close together.

Of equal payloads one record holds the text, the others are revisits of it. An archive counts
only through the index, which Spark commits: a lost task leaves a file that no row names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwelltide.llm.hot_keys import lookup
from dwelltide.session import shared_folder

#: An archive is closed at this size, and a task reads at most such a part of one.
ARCHIVE_BYTES = 256 << 20
PART_BYTES = 64 << 20
#: Ranges at most this far apart are read together, up to this many bytes.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: Payload bytes of a batch that goes back to Spark.
BATCH_BYTES = 16 << 20

INDEX = (
    "file string, offset long, length long, url string, digest string, record_type string, "
    "page_id long, refers_to long"
)
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)
# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"application/http;msgtype=response"
GZIP_MEMBER = 31

_URN = re.compile(rb"<urn:page:(-?[0-9]*)>")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"" if page_id is None else str(page_id).encode())


def _one_line(url: bytes) -> bytes:
    """A URL as a header may hold it: control characters and blanks are percent-encoded."""
    return re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m.group()[0], url)


def record(
    page_id: int | None, url: bytes | None, payload: bytes, digest: str, refers_to: int | None, date: str
) -> bytes:
    """One WARC record. A revisit holds the headers of the answer, with its length, and no text."""
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    lines = [
        VERSION,
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        b"WARC-Record-ID: " + _urn(page_id),
        b"WARC-Date: " + date.encode(),
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"Content-Type: " + HTTP,
    ]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + _one_line(url))
    if revisit:
        lines += [b"WARC-Profile: " + REVISIT_PROFILE, b"WARC-Refers-To: " + _urn(refers_to)]
    else:
        block += payload
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(part: bytes) -> dict[bytes, bytes]:
    pairs = (line.partition(b":") for line in part.split(b"\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _number(urn: bytes | None) -> int | None:
    digits = _URN.fullmatch(urn or b"<urn:page:>")
    if digits is None:
        raise ValueError(f"not a page's name: {urn!r}")
    return int(digits[1]) if digits[1] else None


def parse_record(data: bytes) -> dict:
    """The parts of one record. A payload that does not fit its digest or its length is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no record at this place of the archive")
    fields = _headers(head)
    block = rest[: int(fields[b"content-length"])]
    answer, _, payload = block.partition(b"\r\n\r\n")
    size = int(_headers(answer)[b"content-length"])
    digest = fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
    kind = fields[b"warc-type"].decode()
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged payload of {fields[b'warc-record-id']!r}")
    url = fields.get(b"warc-target-uri")
    return {
        "page_id": _number(fields[b"warc-record-id"]),
        "url": None if url is None else url.decode("utf-8", "replace"),
        "record_type": kind,
        "refers_to": _number(fields.get(b"warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def _file_system(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a folder of any scheme that Arrow knows (local, hdfs, s3, gs, abfs)."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder))


def _writer(folder: str, date: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _file_system(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        out, name, at, files = None, "", 0, 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, sha1, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    if out is None:
                        # A name that no other attempt at this task has.
                        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{files}.warc.gz"
                        out, at, files = store.open_output_stream(f"{base}/{name}", compression=None), 0, files + 1
                    packer = zlib.compressobj(level, zlib.DEFLATED, GZIP_MEMBER)
                    data = record(page_id, url, payload, digest, refers_to, date)
                    member = packer.compress(data) + packer.flush()
                    out.write(member)
                    kind = "response" if refers_to is None else "revisit"
                    shown = None if url is None else url.decode("utf-8", "replace")
                    rows.append((name, at, len(member), shown, digest, kind, page_id, refers_to))
                    at += len(member)
                    if at >= ARCHIVE_BYTES:
                        out.close()
                        out = None
                if rows:
                    yield _batch(rows, _INDEX_TYPES)
        finally:
            if out is not None:
                out.close()

    return run


_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_INDEX_TYPES = [(n, _TYPES[t]) for n, t in (f.split() for f in INDEX.split(", "))]
_RECORD_TYPES = [(n, _TYPES[t]) for n, t in (f.split() for f in RECORDS.split(", "))]


def _batch(rows: list[tuple], types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    arrays = [pa.array(c, type=t) for c, (_, t) in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in types])


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    level: int = 5,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write the pages as archives below ``folder``, and the index of their records into its
    folder ``index``; gives the index.

    Of the pages whose payloads are equal (by SHA-256) and of at least ``min_bytes``, the one
    of the largest id becomes the response, the others revisits that refer to it; shorter ones
    are all responses. Rows that share the largest id are all responses, as are equal payloads
    without any id; a row without an id may be a revisit. A null text is an empty payload, a null URL
    leaves its header out, and control characters and blanks of a URL are percent-encoded. Repeated rows are
    records of their own. An empty table gives an empty index. Other columns are not read.

    Payloads are counted by digest before the shuffle. A payload of very many pages is sent
    to all executors by digest (see ``hot_keys``); the others' table is joined, by broadcast if
    Spark finds it small.
    """
    shared_folder(pages.sparkSession)
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").cast("binary").alias("url"),
        payload.alias("payload"),
        F.unhex(F.sha2(payload, 256)).alias("same"),
    )
    counted = (
        rows.filter(F.octet_length("payload") >= min_bytes)
        .groupBy("same")
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND first_id IS NOT NULL")
        .checkpoint()
    )
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if total:
        known = lookup(rows, counted, ["same"], ["first_id"], "n", total, spread=["page_id", "url"])
    else:
        known = rows.withColumn("first_id", F.lit(None).cast("long"))
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    written = known.select(
        "page_id", "url", "payload", F.sha1("payload").alias("sha1"), refers_to.alias("refers_to")
    ).mapInArrow(_writer(folder, date, level), INDEX)
    written.write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def coalesced(places: Iterable[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """``(file, start, end, records)`` of the reads that cover sorted ``(file, offset, length)``."""
    file, start, end, held = None, 0, 0, []
    for name, offset, length in places:
        near = name == file and offset <= end + GAP_BYTES and max(end, offset + length) - start <= READ_BYTES
        if held and not near:
            yield file, start, end, held
            held = []
        if not held:
            file, start, end = name, offset, offset
        end = max(end, offset + length)
        held.append((offset, length))
    if held:
        yield file, start, end, held


def _reader(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _file_system(folder)
        places = (place for batch in batches for place in zip(*(c.to_pylist() for c in batch.columns)))
        rows, size, opened, source = [], 0, None, None
        names = [n for n, _ in _RECORD_TYPES]
        for file, start, end, records in coalesced(places):
            if file != opened:
                if source is not None:
                    source.close()
                opened, source = file, store.open_input_file(f"{base}/{file}")
            data = source.read_at(end - start, start)
            for offset, length in records:
                found = parse_record(zlib.decompress(data[offset - start : offset - start + length], GZIP_MEMBER))
                if not with_payload:
                    found["payload"] = None
                rows.append(tuple(found[n] for n in names))
                size += len(found["payload"] or b"") + 256
                if size >= BATCH_BYTES:
                    yield _batch(rows, _RECORD_TYPES)
                    rows, size = [], 0
        if source is not None:
            source.close()
        if rows:
            yield _batch(rows, _RECORD_TYPES)

    return run


def read_records(selected: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that rows of the index name: id, URL, type, what a revisit refers to, size and
    digest of the full payload, and the payload of responses (null for revisits).

    Size and digest of a response are those of the bytes that were read; a record that does
    not fit its digest fails the query. A row chosen twice is read twice. A task reads parts
    of ``PART_BYTES`` of the archives, in order.
    """
    part = F.expr(f"offset div {PART_BYTES}")
    placed = selected.select("file", "offset", "length").repartition("file", part)
    return placed.sortWithinPartitions("file", "offset").mapInArrow(_reader(folder, with_payload), RECORDS)
