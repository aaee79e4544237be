"""Streaming sources and windowed statistics.

* ``read_stream``        format-agnostic stream reader (``kafka`` on a cluster
                         with the connector; ``json`` / ``csv`` / ``parquet``
                         file streams elsewhere) with micro-batch sizing
* ``decode_messages``    Kafka-shaped ``value`` bytes -> typed readings
* ``event_time``         parse / cast the event time to ``timestamp`` (the
                         watermark needs it; processing time is an option)
* ``window_stats``       tumbling (or sliding) stats per window and key with a
                         watermark, append mode: a window is emitted once the
                         watermark passes its end
* ``dropped_by_watermark`` late-row count from the last progress report
* ``write_time_ordered`` replay helper: one file per time slice, written in
                         time order so a file stream reads them in order
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.decode import READING, decode_json, flatten, parse_timestamp


def read_stream(spark: SparkSession, fmt: str, path: str | None = None, schema: T.StructType | None = None,
                options: dict | None = None, max_files_per_trigger: int | None = None,
                max_offsets_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    opts = dict(options or {})
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load(path) if path else r.load()


def kafka_options(bootstrap_servers: Sequence[str], topic: str, starting_offsets: str = "latest") -> dict:
    """Reader options for one topic (offsets live in the query checkpoint)."""
    return {"kafka.bootstrap.servers": ",".join(bootstrap_servers), "subscribe": topic,
            "startingOffsets": starting_offsets}


def kafka_sink_options(bootstrap_servers: Sequence[str], topic: str, acks: str = "all", retries: int = 3,
                       linger_ms: int = 10, batch_size: int = 16384) -> dict:
    """Writer options for a keyed result topic (producer settings of the
    original configuration: acks=all, 3 retries, 10 ms linger, 16 KiB batches)."""
    return {"kafka.bootstrap.servers": ",".join(bootstrap_servers), "topic": topic, "kafka.acks": acks,
            "kafka.retries": str(retries), "kafka.linger.ms": str(linger_ms), "kafka.batch.size": str(batch_size)}


def decode_messages(df: DataFrame, schema: T.StructType = READING, keep: Sequence[str] = ()) -> DataFrame:
    """``from_json(value::string)`` then ``data.*`` (plus ``_corrupt``)."""
    return flatten(decode_json(df, "value", schema, keep=tuple(keep)))


def event_time(df: DataFrame, col: str = "timestamp", out: str = "event_time",
               processing_time: bool = False) -> DataFrame:
    """Event time as ``timestamp``: text is parsed, ``timestamp_ntz`` is cast
    (session time zone); ``processing_time=True`` stamps arrival time instead."""
    if processing_time:
        return df.withColumn(out, F.current_timestamp())
    dt = df.schema[col].dataType
    c = parse_timestamp(F.col(col)) if isinstance(dt, T.StringType) else F.col(col).cast("timestamp")
    return df.withColumn(out, c)


def window_stats(df: DataFrame, time_col: str = "event_time", duration: str = "1 minute",
                 watermark: str = "30 seconds", keys: Sequence[str] = ("source", "metric"),
                 value: str = "value", slide: str | None = None) -> DataFrame:
    win = F.window(time_col, duration, slide) if slide else F.window(time_col, duration)
    out = (df.withWatermark(time_col, watermark).groupBy(win.alias("window"), *keys)
           .agg(F.avg(value).alias("avg_value"), F.stddev_samp(value).alias("std_value"),
                F.count(value).alias("count")))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      *keys, "avg_value", "std_value", "count")


def dropped_by_watermark(query) -> int:
    """Rows dropped as late by stateful operators in the last micro-batch."""
    p = query.lastProgress or {}
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in p.get("stateOperators", []))


def write_time_ordered(df: DataFrame, time_col: str, path: str, slices: int, fmt: str = "parquet") -> list[str]:
    """Write ``df`` as ``slices`` files of consecutive time ranges, one after the
    other (file streams order files by modification time).  A replay / test
    helper: each slice becomes one file, so choose ``slices`` from the size."""
    num = F.col(time_col).cast("timestamp").cast("double")
    lo, hi = df.agg(F.min(num), F.max(num)).first()
    if lo is None:
        return []
    width = (hi - lo) / slices if hi > lo else 1.0
    paths = []
    for i in range(slices):
        cond = (num >= lo + i * width) & ((num < lo + (i + 1) * width) if i < slices - 1 else F.lit(True))
        p = f"{path}/part={i:05d}"
        df.where(cond).coalesce(1).write.mode("overwrite").format(fmt).save(p)
        paths.append(p)
    return paths
