"""Series statistics and monitoring aggregates (all map-side combined).

* ``window_stats``        tumbling (or sliding) per-key mean / sample std / count
* ``processing_statistics`` processed, anomalies, rate (fraction and percent)
* ``dashboard_statistics``  the same plus ``last_update``
* ``anomalies_by_source``   distribution of flags by source
* ``anomaly_trend``         anomaly rate per time window
* ``pipeline_metrics``      throughput, anomaly rate, error rate (and latency
                            when a processing time column is present)
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import safe_div


def _rate(anom: Column, total: Column) -> Column:
    return F.coalesce(safe_div(anom.cast("double"), total.cast("double")), F.lit(0.0))


def window_stats(df: DataFrame, time_col: str = "timestamp", duration: str = "1 minute",
                 keys: Sequence[str] = ("source", "metric"), value: str = "value",
                 slide: str | None = None) -> DataFrame:
    """Per (window, keys): ``avg_value``, ``std_value`` (sample std, NULL for one
    row), ``count`` (non-NULL values).  Output has ``window_start`` /
    ``window_end`` columns of the input's timestamp type."""
    win = F.window(time_col, duration, slide) if slide else F.window(time_col, duration)
    out = (df.groupBy(win.alias("window"), *keys)
           .agg(F.avg(value).alias("avg_value"), F.stddev_samp(value).alias("std_value"),
                F.count(value).alias("count")))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      *keys, "avg_value", "std_value", "count")


def processing_statistics(results: DataFrame, keys: Sequence[str] = (), flag: str = "is_anomaly") -> DataFrame:
    """``processed_count``, ``anomaly_count``, ``anomaly_rate`` (fraction) and
    ``anomaly_rate_pct`` (percent, 0 when nothing was processed)."""
    p = F.count(F.lit(1))
    a = F.count_if(F.coalesce(F.col(flag), F.lit(False)))
    grouped = results.groupBy(*keys) if keys else results.groupBy()
    out = grouped.agg(p.alias("processed_count"), a.alias("anomaly_count"))
    return out.withColumns({
        "anomaly_rate": _rate(F.col("anomaly_count"), F.col("processed_count")),
        "anomaly_rate_pct": _rate(F.col("anomaly_count"), F.col("processed_count")) * 100.0,
    })


def dashboard_statistics(results: DataFrame, time_col: str = "timestamp", flag: str = "is_anomaly") -> DataFrame:
    """Global ``total_processed, total_anomalies, anomaly_rate`` (percent, as the
    serving page shows it) and ``last_update`` (latest time seen)."""
    out = results.agg(F.count(F.lit(1)).alias("total_processed"),
                      F.count_if(F.coalesce(F.col(flag), F.lit(False))).alias("total_anomalies"),
                      F.max(time_col).alias("last_update"))
    return out.withColumn("anomaly_rate", _rate(F.col("total_anomalies"), F.col("total_processed")) * 100.0)


def anomalies_by_source(results: DataFrame, source: str = "source", flag: str = "is_anomaly") -> DataFrame:
    """Processed / flagged rows per source (the distribution chart)."""
    return processing_statistics(results, [source], flag)


def anomaly_trend(results: DataFrame, time_col: str = "timestamp", duration: str = "1 day",
                  keys: Sequence[str] = (), flag: str = "is_anomaly") -> DataFrame:
    """Anomaly rate in percent per tumbling window (the trend chart)."""
    out = (results.groupBy(F.window(time_col, duration).alias("w"), *keys)
           .agg(F.count(F.lit(1)).alias("processed_count"),
                F.count_if(F.coalesce(F.col(flag), F.lit(False))).alias("anomaly_count")))
    return out.select(F.col("w.start").alias("window_start"), *keys, "processed_count", "anomaly_count",
                      (_rate(F.col("anomaly_count"), F.col("processed_count")) * 100.0).alias("anomaly_rate_pct"))


def pipeline_metrics(results: DataFrame, quarantine: DataFrame | None = None, time_col: str = "timestamp",
                     duration: str = "1 hour", flag: str = "is_anomaly",
                     processing_col: str | None = None, label: str | None = None) -> DataFrame:
    """Per window: rows, rows per second, anomaly rate, bad rows and error rate;
    with ``processing_col`` also mean / p95 latency in seconds; with ``label``
    also the detection accuracy (model performance)."""
    seconds = F.lit(_seconds(duration))
    good = results.select(F.window(time_col, duration).start.alias("window_start"),
                          F.coalesce(F.col(flag), F.lit(False)).alias("_flag"),
                          ((F.col(processing_col).cast("double") - F.col(time_col).cast("timestamp").cast("double"))
                           if processing_col else F.lit(None).cast("double")).alias("_lat"),
                          F.lit(0).alias("_bad"),
                          ((F.coalesce(F.col(label).cast("boolean"), F.lit(False)) ==
                            F.coalesce(F.col(flag), F.lit(False))).cast("double") if label
                           else F.lit(None).cast("double")).alias("_hit"))
    rows = good
    if quarantine is not None:
        bad = quarantine.select(F.window(time_col, duration).start.alias("window_start"), F.lit(False).alias("_flag"),
                                F.lit(None).cast("double").alias("_lat"), F.lit(1).alias("_bad"),
                                F.lit(None).cast("double").alias("_hit"))
        rows = good.unionByName(bad)
    aggs = [F.count_if(F.col("_bad") == 0).alias("processed_count"),
            F.count_if(F.col("_flag")).alias("anomaly_count"),
            F.sum("_bad").cast("bigint").alias("bad_count")]
    if processing_col:
        aggs += [F.avg("_lat").alias("latency_mean_s"), F.percentile_approx("_lat", 0.95).alias("latency_p95_s")]
    if label:
        aggs.append(F.avg("_hit").alias("accuracy"))
    out = rows.groupBy("window_start").agg(*aggs)
    total = F.col("processed_count") + F.col("bad_count")
    return out.withColumns({
        "rows_per_second": F.col("processed_count") / seconds,
        "anomaly_rate": _rate(F.col("anomaly_count"), F.col("processed_count")),
        "error_rate": _rate(F.col("bad_count"), total),
    })


def _seconds(duration: str) -> float:
    n, unit = duration.split()
    unit = unit.rstrip("s")
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit]
    return float(n) * mult
