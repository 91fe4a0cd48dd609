"""What counts as one JSON record, in both modes and in the log's payloads."""

import pytest
from pyspark.sql import functions as F

from dwelltide.functions.payload import decode_payload
from dwelltide.sources.decode import MALFORMED, decode_json, split_malformed

GOOD = ['{"k":1}', ' {"k":1} ', '{"other":2}']
BAD = [
    '{"k":1}{"k":2}', '{"k":1} garbage', '{"k":1},{"k":2}', "", "  ", None, "nope", "null", "[1]", '[{"k":1}]', "1", '{"k":"x"}', '{"k":1}]',
]


def rows(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")


@pytest.mark.parametrize("text", BAD)
def test_anything_but_one_record_fails(spark, text):
    for decoded in (
        decode_json(rows(spark, [text]), "k bigint"),
        rows(spark, [text]).select(decode_payload("value", "k bigint").alias("r")).select("r.*"),
    ):
        with pytest.raises(Exception):
            decoded.collect()


def test_one_record_is_decoded(spark):
    assert [r["k"] for r in decode_json(rows(spark, GOOD), "k bigint").collect()] == [1, 1, None]
    read = rows(spark, GOOD).select(decode_payload("value", "k bigint").alias("r"))
    assert [r["k"] for r in read.select("r.*").collect()] == [1, 1, None]


def test_anything_else_is_quarantined_with_its_text(spark):
    decoded = decode_json(rows(spark, GOOD + BAD), "k bigint", quarantine=True, keep=("id",))
    good, bad = split_malformed(decoded)
    assert [r["k"] for r in good.orderBy("id").collect()] == [1, 1, None]
    assert [(r["k"], r[MALFORMED]) for r in bad.orderBy("id").collect()] == [(None, t or "") for t in BAD]


def test_the_check_reads_no_column_but_the_payload(spark):
    decoded = decode_json(rows(spark, GOOD).withColumn("x", F.lit(1)), "k bigint")
    assert decoded.columns == ["k"]
