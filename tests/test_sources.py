import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from tidemark.operators.quality import reading_reason, split_valid
from tidemark.sources import decode as dc
from tidemark.sources import files
from tidemark.sources.jdbc import jdbc_options
from tidemark.sources.tables import readings


def _tmp():
    return tempfile.mkdtemp(prefix="tidemark-test-")


def test_json_decode_permissive_and_quarantine(spark):
    msgs = spark.createDataFrame(
        [('{"source": "s1", "value": 1.5, "metric": "cpu", "timestamp": "2024-01-01T12:00:00Z"}',),
         ('{"source": "s1", "value": "oops", "metric": "cpu", "timestamp": "2024-01-01T12:00:01"}',),
         ("not json",), ('{"source": null, "value": 2.0}',), ('{"source": "s2", "metric": "cpu"}',)], "value string")
    dec = dc.flatten(dc.decode_json(msgs))
    good, bad = split_valid(dec, reading_reason())
    assert good.count() == 1
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["malformed_json", "missing_source", "missing_value", "missing_value"]
    ts = dc.flatten(dc.decode_json(msgs)).select(dc.parse_timestamp(F.col("timestamp")).alias("t")).collect()
    assert ts[0].t is not None and ts[1].t is not None


def test_value_chain_and_default_timestamp(spark):
    df = spark.createDataFrame([(None, 3.0, None), (2.0, None, "2024-01-01T00:00:00"), (None, None, None)],
                               "value double, data double, timestamp string")
    out = dc.default_timestamp(dc.value_chain(df)).collect()
    assert [r.value for r in out] == [3.0, 2.0, 0.0]
    assert all(r.timestamp is not None for r in out)


def test_enforce_schema(spark):
    from tidemark.operators.quality import enforce_schema
    raw = spark.createDataFrame([("s", "85.5", "cpu", "2024-01-01T12:00:00Z", "true", "0.95", "spike"),
                                 ("s", "x", "cpu", "2024-01-01T12:00:00Z", "true", "0.95", None),
                                 (None, "1", "cpu", "t", "false", "0.1", None)],
                                "source string, value string, metric string, timestamp string, is_anomaly string, "
                                "anomaly_score string, anomaly_type string")
    out = enforce_schema(raw, dc.ALERT, ["source", "value", "timestamp", "is_anomaly"]).collect()
    assert out[0].reason is None and out[0].value == 85.5 and out[0].is_anomaly is True
    assert out[1].reason == "bad_value"
    assert out[2].reason == "missing_source"


def test_csv_json_roundtrip_batch_and_stream(spark):
    base = _tmp()
    ev = readings(spark, SF001).select("source", "value", "metric",
                                       F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
    files.write_csv(ev, os.path.join(base, "csv"))
    back = files.read_csv(spark, os.path.join(base, "csv"))
    # (Spark refuses a query that reads only the corrupt-record column of raw files)
    assert back.count() == 1000
    assert back.where(F.col(files.CORRUPT).isNotNull() | F.col("value").isNull()).count() == 0
    ev.write.json(os.path.join(base, "json"))
    s = files.read_json(spark, os.path.join(base, "json"), stream=True)
    q = (s.writeStream.format("parquet").option("checkpointLocation", os.path.join(base, "ck"))
         .trigger(availableNow=True).start(os.path.join(base, "out")))
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(base, "out")).count() == 1000


def test_keyed_encoding(spark):
    df = readings(spark, SF001).limit(3)
    enc = dc.encode_json(df, "source").collect()
    assert all(r.key for r in enc) and all(r.value.startswith("{") for r in enc)


def test_jdbc_options():
    o = jdbc_options("jdbc:postgresql://db/x", "results", partition_column="id", lower_bound=0,
                     upper_bound=1000, num_partitions=8)
    assert o["numPartitions"] == "8" and o["partitionColumn"] == "id"
    import pytest
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")
