"""Accuracy of a running detector against labels that arrive later.

Predictions and labels are two streams.  They meet in a watermarked
stream-stream join on the id within a time range: a label counts if it comes at
most ``wait`` after its reading.  The join keeps a prediction in state until the
watermark shows that no label can come any more; it then comes out without one.
Joined rows are counted per time window and key, so each window is emitted once,
complete, when the watermark has passed it.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import safe_div


def match_labels(predictions: DataFrame, labels: DataFrame, id: str = "event_id", time_col: str = "event_time",
                 label_time: str = "label_time", label: str = "label", wait: str = "1 hour",
                 watermark: str = "10 minutes") -> DataFrame:
    """Each prediction with its ``label`` (NULL if none came within ``wait``).  A label that is sent twice gives its prediction twice."""
    p = predictions.withWatermark(time_col, watermark)
    late = labels.select(F.col(id).alias("_label_id"), label_time, label).withWatermark(label_time, watermark)
    inside = F.expr(f"{id} = _label_id AND {label_time} >= {time_col} AND {label_time} <= {time_col} + INTERVAL {wait}")
    return p.join(late, inside, "leftOuter").drop("_label_id", label_time)


def windowed_accuracy(matched: DataFrame, keys: Sequence[str] = ("source",), time_col: str = "event_time",
                      duration: str = "1 day", pred: str = "is_anomaly", label: str = "label") -> DataFrame:
    """Per window and key: rows, labelled rows, and precision, recall, f1 and accuracy over the labelled ones (0 where undefined)."""
    y, p = F.col(label).cast("boolean"), F.coalesce(F.col(pred), F.lit(False))
    out = matched.groupBy(F.window(time_col, duration).alias("window"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.count(y).alias("n_labelled"), F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))

    def share(a, b):
        return F.coalesce(safe_div(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return out.select(F.col("window.start").alias("window_start"), *keys, "n", "n_labelled",
                      share(tp, tp + fp).alias("precision"), share(tp, tp + fn).alias("recall"),
                      share(2 * tp, 2 * tp + fp + fn).alias("f1"), share(tp + tn, F.col("n_labelled")).alias("accuracy"))
