"""Rolling detector on a stream, one distributed batch job per micro-batch.

``applyInPandasWithState`` handles a key's rows of a micro-batch in one
Python call.  ``start_rolling_detector`` instead treats every micro-batch as a
batch problem inside ``foreachBatch``:

* the state is a versioned table under ``state_path``: for micro-batch N,
  ``epoch=N/rows`` holds each key's last ``window_size - 1`` rows and
  ``epoch=N/seen`` each key's number of rows seen so far;
* micro-batch N reads ``epoch=N-1``, puts those rows before its own rows
  (the buffer history) and scores with the hot-key-safe ``over_series``
  windows (JVM window functions; a hot key is chunked across tasks);
* results go to ``sink_path/batch_id=N`` and the next state to
  ``epoch=N``, both overwritten -- a retried micro-batch produces the same
  files, so the output is exactly-once;
* the state lies beside the query's checkpoint; a missing ``epoch=N-1`` is an
  error, never a cold start, and states older than it are deleted.

Rows are scored in arrival order (a batch's rows sorted by the order columns
after the state's rows), the same semantics as ``rolling_detector_stream``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.base import with_detection
from tidemark.operators.rolling import RN, over_series, DEFAULT_HOT_KEY_ROWS
from tidemark.operators.scaling import join_params, null_safe_join
from tidemark.operators.statistical import clean, iqr_columns, zscore_columns
from tidemark.functions.exprs import sorted_quantile
from tidemark.session import scratch_path

SEG = "_seg"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def score_microbatch(batch: DataFrame, epoch: int, keys: Sequence[str], order: Sequence[str], value: str,
                     sink_path: str, state_path: str, method: str = "zscore", threshold: float = 3.0,
                     window_size: int = 100, min_history: int = 10,
                     hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS, chunk_rows: int = 1_000_000,
                     members: dict | None = None, weights: dict | None = None,
                     ensemble_threshold: float = 0.5) -> None:
    """Score one micro-batch.  With ``members`` (fitted models by name, e.g.
    an isolation forest) the rolling detector becomes the ``statistical``
    member of an ensemble: ``score = sum(w * s) / sum(w)``, flag iff
    ``score > ensemble_threshold``, plus ``detector_results``."""
    spark = batch.sparkSession
    keys, order = list(keys), list(order)
    cols = batch.columns
    prev = f"{state_path}/epoch={epoch - 1}"
    have_prev = epoch > 0
    if have_prev and not _exists(spark, f"{prev}/_DONE"):
        raise RuntimeError(f"no detector state {prev}: the state folder does not belong to this checkpoint")
    new = batch.withColumn(SEG, F.lit(1))
    if have_prev:
        hist = spark.read.parquet(f"{prev}/rows").withColumn(SEG, F.lit(0))
        seen = spark.read.parquet(f"{prev}/seen")
        data = hist.unionByName(new, allowMissingColumns=True)
    else:
        seen = None
        data = new
    base = data.persist(StorageLevel.MEMORY_AND_DISK)  # read by the scoring and the next state
    data = base
    try:
        if seen is not None:
            # rows of a key seen before but no longer in the W-1 buffer still count for the gate
            held = data.where(F.col(SEG) == 0).groupBy(*keys).agg(F.count(F.lit(1)).alias("_held"))
            extra = null_safe_join(seen, held, keys, "left").select(
                *keys, (F.col("_seen") - F.coalesce("_held", F.lit(0))).alias("_extra"))
            data = join_params(data, extra, keys)
        else:
            data = data.withColumn("_extra", F.lit(0).cast("bigint"))

        v = clean(data, value)

        def frame_cols(w):
            fr = w.rowsBetween(-(window_size - 1), -1)
            if method == "iqr":
                return {"_q": F.sort_array(F.collect_list(v).over(fr))}
            return {"_m": F.avg(v).over(fr), "_sd": F.stddev_pop(v).over(fr)}

        out = over_series(data, keys, [SEG] + order, frame_cols, halo_before=window_size - 1,
                          hot_key_rows=hot_key_rows, chunk_rows=chunk_rows)
        if method == "iqr":
            flag, score = iqr_columns(v, sorted_quantile("_q", 0.25), sorted_quantile("_q", 0.75), threshold)
            kind = "iqr"
        else:
            flag, score = zscore_columns(v, F.col("_m"), F.col("_sd"), threshold)
            kind = "zscore"
        warm = (F.col(RN) - 1 + F.coalesce(F.col("_extra"), F.lit(0))) >= min_history
        out = with_detection(out.where(F.col(SEG) == 1), F.when(warm, flag).otherwise(False),
                             F.when(warm, score).otherwise(0.0),
                             F.when(warm, F.lit(kind)).otherwise(F.lit("statistical")))
        out = out.select(*cols, "is_anomaly", "anomaly_score", "anomaly_type")
        if members:
            out = _ensemble(out, members, weights or {}, ensemble_threshold)
        out.write.mode("overwrite").parquet(f"{sink_path}/batch_id={epoch}")

        # next state: each key's last W-1 rows (a per-key top-k: bounded per
        # partition before the shuffle) and the seen counts
        from pyspark.sql import Window
        w_last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in [SEG] + order])
        keep = (data.withColumn("_k", F.row_number().over(w_last)).where(F.col("_k") <= window_size - 1)
                .select(*cols))
        here = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        if seen is not None:
            # union + group-by keeps a NULL key as one group
            nseen = (seen.select(*keys, "_seen").unionByName(here.select(*keys, F.col("_n").alias("_seen")))
                     .groupBy(*keys).agg(F.sum("_seen").alias("_seen")))
        else:
            nseen = here.select(*keys, F.col("_n").alias("_seen"))
        cur = f"{state_path}/epoch={epoch}"
        keep.write.mode("overwrite").parquet(f"{cur}/rows")
        nseen.write.mode("overwrite").parquet(f"{cur}/seen")
        spark.createDataFrame([(epoch,)], "epoch long").write.mode("overwrite").parquet(f"{cur}/_DONE")
        _delete(spark, f"{state_path}/epoch={epoch - 2}")  # a retry of this micro-batch reads epoch - 1
    finally:
        base.unpersist()


def _ensemble(scored: DataFrame, members: dict, weights: dict, threshold: float) -> DataFrame:
    """Combine the statistical detection with other fitted members."""
    out = scored.withColumnsRenamed({"is_anomaly": "_m_statistical_is_anomaly",
                                     "anomaly_score": "_m_statistical_anomaly_score",
                                     "anomaly_type": "_m_statistical_anomaly_type"})
    names = ["statistical"] + list(members)
    for name, model in members.items():
        out = model.transform(out, prefix=f"_m_{name}_")
    total, wsum, entries = F.lit(0.0), 0.0, []
    for name in names:
        p = f"_m_{name}_"
        w = float(weights.get(name, 1.0))
        total, wsum = total + F.col(f"{p}anomaly_score") * F.lit(w), wsum + w
        entries += [F.lit(name), F.struct(F.col(f"{p}is_anomaly").alias("is_anomaly"),
                                          F.col(f"{p}anomaly_score").alias("score"),
                                          F.col(f"{p}anomaly_type").alias("type"))]
    final = total / F.lit(wsum) if wsum > 0 else F.lit(0.0)
    out = out.withColumn("detector_results", F.create_map(*entries))
    out = with_detection(out, final > F.lit(threshold), final, "ensemble")
    return out.drop(*[c for c in out.columns if c.startswith("_m_")])


def start_rolling_detector(stream: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                           sink_path: str, state_path: str | None = None, checkpoint: str | None = None,
                           trigger: dict | None = None, **params):
    """Start the query; ``params`` go to ``score_microbatch`` (method, threshold,
    window_size, min_history, hot_key_rows, chunk_rows, members, weights,
    ensemble_threshold)."""
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "detector-ckpt")
    state_path = state_path or f"{checkpoint}/detector-state"

    def run(batch: DataFrame, epoch: int):
        score_microbatch(batch, epoch, keys, order, value, sink_path, state_path, **params)

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()
