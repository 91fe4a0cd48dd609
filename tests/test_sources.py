"""Named streams and option precedence."""

import pytest

from dwelltide.sources.streams import (
    CLIENT_LOG,
    CONNECTOR_DEFAULTS,
    FLAT_EVENT,
    Stream,
    from_latest,
    preset,
    text_stream,
)


def collect_stream(spark, rows, folder):
    query = (
        rows.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = spark.read.schema(rows.schema).parquet(f"{folder}/out").collect()
    return sorted(tuple(r) for r in found)


def test_the_caller_wins_over_the_stream_and_the_stream_over_defaults():
    stream = Stream(
        "arn", FLAT_EVENT, format="kinesis", decoder="json",
        options={"region": "r1", "scan.stream.initpos": "TRIM_HORIZON"},
    )
    options = stream.all_options({"region": "r2"})
    assert options == {**CONNECTOR_DEFAULTS["kinesis"], "scan.stream.initpos": "TRIM_HORIZON", "region": "r2"}
    assert stream.with_options(region="r3").all_options()["region"] == "r3"
    assert Stream("path", FLAT_EVENT).all_options() == {}


def test_presets():
    assert preset("flat", "/base/").location == "/base/flat"
    assert preset("flat", "/base").schema == FLAT_EVENT
    assert preset("client_log", "/base").schema == CLIENT_LOG
    assert preset("raw", "/base", "a int", decoder="json").decoder == "json"
    with pytest.raises(ValueError, match="schema"):
        preset("raw", "/base")
    with pytest.raises(KeyError, match="client_log"):
        preset("other", "/base")


def test_clear_errors(spark):
    for wrong in (Stream("x"), Stream("x", decoder="json"), Stream("x", "a int", decoder="avro")):
        with pytest.raises(ValueError, match="stream 'x'"):
            wrong.table(spark)
    with pytest.raises(ValueError, match="quarantined"):
        Stream("x", "a int").table(spark, quarantine=True)


def test_table_and_stream_of_one_preset(spark, tmp_path):
    rows = [("a", 1, 5), ("b", None, 6)]
    spark.createDataFrame(rows, FLAT_EVENT).write.parquet(f"{tmp_path}/flat")
    stream = preset("flat", str(tmp_path))
    assert sorted(tuple(r) for r in stream.table(spark).collect()) == rows
    assert collect_stream(spark, stream.source(spark), tmp_path) == rows


def test_payload_stream(spark, tmp_path):
    stream = Stream(f"{tmp_path}/log", FLAT_EVENT, decoder="json", payload="payload")
    rows = [("a", 1, 2**53 + 1), ("b", None, 6)]
    stream.sink()(spark.createDataFrame(rows, FLAT_EVENT), 0)
    assert sorted(tuple(r) for r in stream.table(spark).collect()) == rows
    assert collect_stream(spark, stream.source(spark), tmp_path) == rows


def test_the_caller_wins_on_the_sink_too(spark, tmp_path):
    stream = Stream(f"{tmp_path}/log", options={"compression": "gzip"})
    rows = spark.createDataFrame([("a", 1, 5)], FLAT_EVENT)
    stream.sink()(rows, 0)
    stream.sink({"compression": "none"})(rows, 1)
    files = [[p.name for p in tmp_path.glob(f"log/batch_id={n}/*/*.parquet")] for n in (0, 1)]
    assert ".gz." in files[0][0] and ".gz." not in files[1][0]
    with pytest.raises(ValueError, match="parquet"):
        Stream("arn", format="kinesis").sink()


def test_text_stream(spark, tmp_path):
    spark.createDataFrame([("x y",), ("",)], "value string").write.text(f"{tmp_path}/in")
    rows = text_stream(f"{tmp_path}/in").source(spark)
    assert collect_stream(spark, rows, tmp_path) == [("",), ("x y",)]


def test_json_files(spark, tmp_path):
    rows = [("a", 1, 5), ("b", None, 6)]
    spark.createDataFrame(rows, FLAT_EVENT).write.json(f"{tmp_path}/in")
    stream = Stream(f"{tmp_path}/in", FLAT_EVENT, format="json")
    assert sorted(tuple(r) for r in stream.table(spark).collect()) == rows


def test_start_at_latest(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 1, 6)], FLAT_EVENT)
    assert [r["recv_timestamp"] for r in from_latest(rows, 6).collect()] == [6]


def test_a_connector_has_its_own_options_only():
    assert Stream("s", FLAT_EVENT, format="kafka", decoder="json").all_options() == {}
    late = Stream("s", FLAT_EVENT, format="kafka", decoder="json", starting="latest")
    assert late.all_options() == {"startingOffsets": "latest"}
    early = Stream("s", FLAT_EVENT, format="kinesis", decoder="json", starting="earliest")
    assert early.all_options()["startingposition"] == "TRIM_HORIZON"
    assert late.all_options({"startingOffsets": "earliest"}) == {"startingOffsets": "earliest"}


def test_files_start_at_a_time(spark, tmp_path):
    spark.createDataFrame([("a", 1, 5), ("b", 1, 9)], FLAT_EVENT).write.parquet(f"{tmp_path}/flat")
    late = preset("flat", str(tmp_path), starting="latest", start_ms=9)
    assert [r["device_id"] for r in late.table(spark).collect()] == ["b"]
    assert preset("flat", str(tmp_path), starting="latest").table(spark).count() == 0
    assert preset("flat", str(tmp_path), starting="earliest").table(spark).count() == 2
    with pytest.raises(ValueError, match="latest"):
        preset("flat", str(tmp_path), starting="yesterday").table(spark)


def test_functions_for_decoder_encoder_and_key(spark, tmp_path):
    from pyspark.sql import functions as F

    from dwelltide.streaming.sinks import read_log

    spark.createDataFrame([(b"a;1",), (b"b;2",)], "value binary").write.parquet(f"{tmp_path}/in")
    own = Stream(
        f"{tmp_path}/in",
        decoder=lambda v: F.from_csv(v.cast("string"), "name string, n int", {"sep": ";", "mode": "FAILFAST"}),
    )
    rows = own.table(spark)
    assert sorted(map(tuple, rows.collect())) == [("a", 1), ("b", 2)]
    out = Stream(
        f"{tmp_path}/log",
        encoder=lambda names: F.concat_ws("|", *names),
        key=lambda names: F.upper(names[0]),
        key_columns=["name"],
    )
    out.sink()(rows, 0)
    found = sorted((r["partition_key"], bytes(r["payload"])) for r in read_log(spark, f"{tmp_path}/log").collect())
    assert found == [("A", b"a|1"), ("B", b"b|2")]
