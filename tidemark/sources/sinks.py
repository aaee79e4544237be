"""Sinks and the result envelope.

Message-bus sinks are written format-agnostically: ``write_keyed`` takes the
format name (``kafka`` on a cluster with the connector; ``json`` / ``parquet``
/ ``memory`` elsewhere).  Every streaming sink gets its own checkpoint path
under the shared checkpoint folder.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.decode import encode_json
from tidemark.session import scratch_path


def envelope(df: DataFrame, original: Sequence[str], transformed: Sequence[str] = (),
             source: str = "source", metric: str = "metric") -> DataFrame:
    """Result envelope: original record, transformed record, detection fields,
    processing time, source and metric."""
    cols = [F.struct(*original).alias("original_data")]
    cols.append(F.struct(*transformed).alias("transformed_data") if transformed
                else F.lit(None).cast("struct<>").alias("transformed_data"))
    cols += ["is_anomaly", "anomaly_score", "anomaly_type",
             F.current_timestamp().alias("processing_timestamp"),
             F.col(source).alias("source"), F.col(metric).alias("metric")]
    return df.select(*cols)


def alerts_view(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Serving (alert) schema: source, value, metric, ISO timestamp, detection."""
    return df.select("source", "value", "metric",
                     F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
                     "is_anomaly", "anomaly_score", "anomaly_type")


def write_keyed(df: DataFrame, fmt: str, options: dict | None = None, key_col: str = "source",
                path: str | None = None, mode: str = "append") -> None:
    """Batch write of ``(key, value=json)`` messages."""
    w = encode_json(df, key_col).write.format(fmt).mode(mode)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path) if path else w.save()


def start_keyed_stream(df: DataFrame, fmt: str, options: dict | None = None, key_col: str = "source",
                       path: str | None = None, checkpoint: str | None = None, output_mode: str = "append",
                       trigger: dict | None = None, query_name: str | None = None):
    """Streaming keyed sink (Kafka-shaped ``key``/``value`` columns)."""
    spark: SparkSession = df.sparkSession
    w = (encode_json(df, key_col).writeStream.format(fmt).outputMode(output_mode)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "sink")))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path) if path else w.start()


def start_console(df: DataFrame, output_mode: str = "append", checkpoint: str | None = None):
    """Console sink without truncation (debugging)."""
    return (df.writeStream.format("console").outputMode(output_mode).option("truncate", False)
            .option("checkpointLocation", checkpoint or scratch_path(df.sparkSession, "console")).start())


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Experiment report as JSON lines (nested columns stay nested)."""
    df.write.mode(mode).json(path)
