"""Payloads, JSON text, keys, sizes and decoders."""

import datetime
import json
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dwelltide.functions.payload import (
    MAX_RECORD_BYTES,
    decode_payload,
    encode_payload,
    is_oversized,
    partition_key,
)
from dwelltide.functions.proto_json import json_name, proto_json
from dwelltide.operators.records import oversized_records
from dwelltide.sources.decode import decode_binary, decode_json, decode_text, split_malformed

UTC = datetime.timezone.utc


def test_rows_of_all_types_survive_the_trip(spark):
    schema = (
        "b boolean, i int, l bigint, f double, d decimal(20,4), s string, x binary, "
        "day date, t timestamp, n timestamp_ntz, a array<int>, m map<string,bigint>, "
        "r struct<p: string, q: array<struct<z: bigint>>>"
    )
    moment = datetime.datetime(2024, 2, 29, 23, 59, 59, 123456)
    full = (
        True, -5,
        2**63 - 1, 1e-300, Decimal('123456789012.3456'), 'quote " \n ünï', b"\x00\xff",
        datetime.date(1969, 12, 31), moment.replace(tzinfo=UTC), moment, [1, None, 3],
        {"k": 2**60, "": 0}, ("", [(None,), (7,)]),
    )
    edges = (False, 0, -(2**63), math.inf, Decimal(0), "", b"", None, None, None, [], {}, (None, []))
    rows = spark.createDataFrame([full, edges, (None,) * 13], schema)
    back = rows.select(encode_payload(rows.columns).alias("p")).select(
        decode_payload("p", rows.schema).alias("row")
    ).select("row.*")
    assert back.dtypes == rows.dtypes
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))


def test_key_of_whole_row_or_of_some_columns(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2)], "d string, v int")
    whole = [r[0] for r in rows.select(partition_key(["d", "v"])).collect()]
    device = [r[0] for r in rows.select(partition_key(["d"])).collect()]
    assert whole[0] != whole[1] == whole[2]
    assert len(set(device)) == 1 and isinstance(device[0], str)


def test_a_record_of_exactly_the_limit_is_written(spark):
    sizes = spark.createDataFrame([(MAX_RECORD_BYTES,), (MAX_RECORD_BYTES + 1,)], "n int")
    records = sizes.select("n", F.expr("cast(repeat('x', n) as binary)").alias("payload"))
    flags = {r[0]: r[1] for r in records.select("n", is_oversized("payload")).collect()}
    assert flags == {MAX_RECORD_BYTES: False, MAX_RECORD_BYTES + 1: True}


def test_sizes_are_bytes(spark):
    rows = spark.createDataFrame([("ü" * 6,), ("u" * 10,)], "text string")
    assert [r["n_bytes"] for r in oversized_records(rows, "text", 10).collect()] == [12]


def test_json_names():
    assert [json_name(n) for n in ("recv_timestamp", "a", "device__id", "x_1", "tail_")] == [
        "recvTimestamp", "a", "deviceId", "x1", "tail",
    ]


def lines(rows, **how):
    return [json.loads(r[0]) for r in rows.select(proto_json(rows, **how)).collect()]


def test_long_as_text_and_defaults_omitted(spark):
    rows = spark.createDataFrame(
        [(9007199254740993, 0, "", False, 0.0), (0, 3, "x", True, 2.5), (None,) * 5],
        "recv_timestamp bigint, view_time int, name string, on_air boolean, score double",
    )
    assert lines(rows) == [
        {"recvTimestamp": "9007199254740993"},
        {"viewTime": 3, "name": "x", "onAir": True, "score": 2.5},
        {},
    ]


def test_optional_columns_keep_their_defaults(spark):
    rows = spark.createDataFrame([(0, 0), (None, 0)], "view_time int, other int")
    assert lines(rows, optional=["view_time"]) == [{"viewTime": 0}, {}]


def test_nested_values(spark):
    rows = spark.createDataFrame(
        [
            (("", 0), [1, 0], {"k": 0}, b"\x01", datetime.datetime(2024, 1, 2, tzinfo=UTC),
             [("u", 5)], math.nan),
            (None, [], {}, b"", None, None, 0.0),
        ],
        "inner_part struct<a_b: string, c: bigint>, n array<bigint>, m map<string,int>, "
        "raw binary, seen_at timestamp, list array<struct<x_y: string, z: bigint>>, f double",
    )
    assert lines(rows) == [
        {
            "innerPart": {}, "n": ["1", "0"], "m": {"k": 0}, "raw": "AQ==",
            "seenAt": "2024-01-02T00:00:00.000000Z", "list": [{"xY": "u", "z": "5"}], "f": "NaN",
        },
        {},
    ]


def test_malformed_json_fails_the_query(spark):
    rows = spark.createDataFrame([(b'{"k":1}',), (b"nope",)], "value binary")
    with pytest.raises(Exception, match="(?i)malformed"):
        decode_json(rows, "k bigint").collect()


def test_malformed_json_in_quarantine(spark):
    rows = spark.createDataFrame([(b'{"k":1}',), (b"nope",)], "value binary")
    good, bad = split_malformed(decode_json(rows, "k bigint", quarantine=True))
    assert [tuple(r) for r in good.collect()] == [(1,)]
    assert [r["malformed_payload"] for r in bad.collect()] == ["nope"]


def test_text_and_binary_decoders(spark):
    rows = spark.createDataFrame([("häh".encode(),)], "value binary")
    assert decode_text(rows).head()[0] == "häh"
    assert bytes(decode_binary(rows).head()[0]) == "häh".encode()
