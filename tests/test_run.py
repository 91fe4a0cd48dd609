"""Starting jobs from the command line."""

import pytest

from dwelltide.plans.run import arguments, main
from dwelltide.sources.streams import CLIENT_LOG, FLAT_EVENT
from dwelltide.streaming.sinks import read_log
from tests.streams import HOUR


@pytest.fixture
def streams(spark, tmp_path):
    flat = [("a", 1, 0), ("a", 2, HOUR), ("b", 0, 500 * 24 * HOUR)]
    spark.createDataFrame(flat, FLAT_EVENT).write.parquet(f"{tmp_path}/flat")
    spark.createDataFrame([("tv", "1")], CLIENT_LOG).write.parquet(f"{tmp_path}/client_log")
    spark.createDataFrame([("d", 0)], "device_id string, n int").write.parquet(f"{tmp_path}/raw")
    spark.createDataFrame([("x",)], "value string").write.text(f"{tmp_path}/lines")
    return str(tmp_path)


@pytest.mark.parametrize("more", [[], ["--state", "table"], ["--final"], ["--final", "--merge-late"]])
def test_device_features(spark, streams, more):
    final = "--final" in more
    main(
        ["device-features", "--streams", streams, "--jobs", f"{streams}/jobs", "--once"]
        + ["--state-partitions", "2", "--option", "maxFilesPerTrigger=100"]
        + ["--buckets", "3", *more]
    )
    records = read_log(
        spark, f"{streams}/jobs/device_features/{'final/' if final else ''}log"
    ).count()
    # Live, and closed; in a table at once, as all rows come in one micro-batch.
    assert records == (1 if final or more else 2)


def test_printing(spark, streams):
    out = f"{streams}/out"
    main(
        ["print-clients-and-events", "--streams", streams, "--raw-schema"]
        + ["device_id string, n int", "--once", "--to", out]
    )
    main(["print-text", "--streams", f"{streams}/lines", "--once", "--to", out])
    found = [spark.read.parquet(f"{out}/{name}").head()[0] for name in ("raw_events", "lines")]
    assert found == ['{"deviceId":"d"}', "x"]


def test_wrong_arguments(capsys):
    for wrong in ([], ["print-text"], ["print-text", "--streams", "s", "--option", "x"]):
        with pytest.raises(SystemExit):
            arguments(wrong)
    assert "key=value" in capsys.readouterr().err


def test_settings_metrics_and_quarantine(spark, tmp_path):
    texts = ['{"device_id":"a","view_time":1,"recv_timestamp":1}', "broken", '{"device_id":"b","view_time":2,"recv_timestamp":2}']
    spark.createDataFrame([(t.encode(),) for t in texts], "value binary").write.parquet(f"{tmp_path}/flat")
    main(
        ["device-features", "--streams", str(tmp_path), "--jobs", f"{tmp_path}/jobs", "--once", "--decoder", "json"]
        + ["--quarantine", "--writers", "1", "--buckets", "2", "--state-partitions", "2"]
        + ["--starting", "earliest"]
    )
    own = f"{tmp_path}/jobs/device_features"
    assert [r[0] for r in spark.read.parquet(f"{own}/quarantine").collect()] == ["broken"]
    metrics = spark.read.parquet(f"{own}/metrics").filter("query = 'device_features'")
    emitted = metrics.selectExpr("sum(cast(get_json_object(metrics['emitted'], '$.n') as int))").first()[0]
    assert emitted == read_log(spark, f"{own}/log").count() == 2
