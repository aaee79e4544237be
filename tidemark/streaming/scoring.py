"""Stateless model scoring, running counters and alert emission on streams.

* ``BaselineModel``  per-key mean / population std fitted on a table; a stream
                     is scored by a stream-static join on the key (broadcast
                     only when the parameter table is small, checked on fit)
* ``score_stream``   any stateless model (baseline, isolation forest,
                     one-class SVM) applied to a stream (C2 / K7)
* ``start_counters`` running processed / anomaly counts per key (K6): each
                     micro-batch adds the keys it changed; ``latest_counters``
                     reads the newest count of each key
* ``start_alerts``   flagged rows validated against the alert schema and
                     appended to an alerts table, invalid ones to quarantine (K8)
* ``merge_streams``  union of several reading streams (G2)
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.statistical import clean, zscore_columns
from tidemark.functions.exprs import safe_div
from tidemark.operators.base import Model, with_detection
from tidemark.operators.quality import enforce_schema
from tidemark.session import materialize, scratch_path
from tidemark.sources.decode import ALERT

BROADCAST_ROWS = 100_000


class BaselineModel(Model):
    """Static z-score against a fitted per-key baseline."""

    kind = "baseline_zscore"

    def __init__(self, params: DataFrame, keys: Sequence[str], value: str, threshold: float, small: bool):
        self.params, self.keys, self.value, self.threshold, self.small = params, list(keys), value, threshold, small

    @classmethod
    def fit(cls, df: DataFrame, keys: Sequence[str] = ("source",), value: str = "value", threshold: float = 3.0):
        p = materialize(df.groupBy(*keys).agg(F.avg(clean(df, value)).alias("_mean"), F.stddev_pop(clean(df, value)).alias("_sd")), "baseline")
        return cls(p, keys, value, threshold, p.count() <= BROADCAST_ROWS)

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        from tidemark.operators.scaling import null_safe_join
        j = null_safe_join(df, self.params, self.keys, "left", broadcast=self.small)
        flag, score = zscore_columns(clean(df, self.value), F.col("_mean"), F.col("_sd"), self.threshold)
        out = with_detection(j, flag, score, self.kind, prefix)
        return out.drop("_mean", "_sd")


def score_stream(stream: DataFrame, model: Model) -> DataFrame:
    return model.transform(stream)


def merge_streams(*streams: DataFrame) -> DataFrame:
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def start_counters(scored: DataFrame, table_path: str, keys: Sequence[str] = ("source",),
                   checkpoint: str | None = None, trigger: dict | None = None):
    """Running counters per key.  Each micro-batch writes the keys it changed under its batch id, so nothing a
    reader has open is replaced and a retried micro-batch writes the same rows; ``latest_counters`` reads them."""
    counts = (scored.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("processed_count"),
                   F.count_if(F.coalesce(F.col("is_anomaly"), F.lit(False))).alias("anomaly_count")))

    def write(batch: DataFrame, epoch: int):
        batch.write.mode("overwrite").parquet(f"{table_path}/batch_id={epoch}")

    w = (counts.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint or scratch_path(scored.sparkSession, "counters")))
    return (w.trigger(**trigger) if trigger else w).start()


def latest_counters(spark, table_path: str, keys: Sequence[str] = ("source",)) -> DataFrame:
    """The newest counts of each key: ``keys, processed_count, anomaly_count, anomaly_rate``."""
    rows = spark.read.parquet(table_path)
    newest = F.max_by(F.struct("processed_count", "anomaly_count"), "batch_id").alias("c")
    out = rows.groupBy(*keys).agg(newest).select(*keys, "c.processed_count", "c.anomaly_count")
    return out.withColumn("anomaly_rate", F.coalesce(
        safe_div(F.col("anomaly_count").cast("double"), F.col("processed_count").cast("double")), F.lit(0.0)))


def start_alerts(scored: DataFrame, alerts_path: str, quarantine_path: str, checkpoint: str | None = None,
                 trigger: dict | None = None, ts: str = "timestamp"):
    """Append flagged rows (alert schema, validated) per micro-batch."""
    flagged = scored.where(F.col("is_anomaly")).select(
        "source", "value", "metric",
        F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "is_anomaly", "anomaly_score", "anomaly_type")

    def write(batch: DataFrame, epoch: int):
        typed = enforce_schema(batch.select(*[F.col(c).cast("string") for c in ALERT.fieldNames()]), ALERT,
                               ["source", "value", "timestamp", "is_anomaly"])
        # idempotent per batch id: a retried batch rewrites its own partition
        typed.where("reason IS NULL").drop("reason").write.mode("overwrite") \
            .parquet(f"{alerts_path}/batch_id={epoch}")
        typed.where("reason IS NOT NULL").write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={epoch}")

    w = (flagged.writeStream.outputMode("append").foreachBatch(write)
         .option("checkpointLocation", checkpoint or scratch_path(scored.sparkSession, "alerts")))
    return (w.trigger(**trigger) if trigger else w).start()


def deploy(spark, registry_root: str, name: str, stream: DataFrame) -> DataFrame:
    """Score a stream with the newest registered model called ``name`` (I6).

    Stateless models only (isolation forest, one-class SVM); a statistical
    model needs per-key state and runs through ``rolling_detector_stream``."""
    from tidemark.plans.registry import load_latest
    from tidemark.operators.statistical import StatisticalModel
    model = load_latest(spark, registry_root, name)
    if isinstance(model, StatisticalModel):
        from tidemark.streaming.stateful import rolling_detector_stream
        return rolling_detector_stream(stream, model.spec.keys, model.spec.order, model.spec.value,
                                       model.method, model.threshold, model.window_size, model.min_history)
    return model.transform(stream)


def score_messages(messages: DataFrame, model: Model, sink_path: str, quarantine_path: str,
                   checkpoint: str | None = None, trigger: dict | None = None, fmt: str = "json",
                   options: dict | None = None):
    """The per-record path as one streaming query: JSON message text (``value``)
    -> typed reading -> quarantine of bad records (with ``reason``) -> score
    with a stateless model -> result envelope -> keyed ``(key, value=json)``
    messages.  Each micro-batch writes its results and its quarantined rows
    under its batch id (idempotent)."""
    from tidemark.operators.quality import reading_reason
    from tidemark.sources.decode import decode_json, encode_json, flatten, parse_timestamp
    from tidemark.sources.sinks import envelope

    spark = messages.sparkSession
    dec = flatten(decode_json(messages, "value"))
    dec = dec.withColumn("event_time", parse_timestamp(F.col("timestamp")))
    tagged = dec.withColumn("reason", reading_reason("value", "event_time", "source", "_corrupt"))

    def write(batch: DataFrame, epoch: int):
        batch = batch.persist()
        try:
            good = batch.where(F.col("reason").isNull()).drop("reason", "_corrupt")
            scored = model.transform(good)
            env = envelope(scored, ["source", "value", "metric", "timestamp"],
                           ["source", "value", "metric", "event_time"])
            out = encode_json(env, "source")
            w = out.write.mode("overwrite").format(fmt)
            for k, v in (options or {}).items():
                w = w.option(k, v)
            w.save(f"{sink_path}/batch_id={epoch}")
            batch.where(F.col("reason").isNotNull()).write.mode("overwrite") \
                .parquet(f"{quarantine_path}/batch_id={epoch}")
        finally:
            batch.unpersist()

    w = (tagged.writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "messages-ckpt")))
    return (w.trigger(**trigger) if trigger else w).start()
