"""Evaluation of detections against labels.

All metrics come from one aggregation pass (four conditional counts), so
evaluating a 100 TB result table costs one scan and a one-row merge.

* ``confusion_cells`` -- long format (label, prediction, count), 4 rows
* ``classification_report`` -- weighted precision / recall / f1 (support
  weighted, zero division -> 0), accuracy and the 2x2 matrix (rows = truth,
  order [False, True])
* ``unlabelled_metrics`` -- anomaly rate, mean score, population std of score
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import safe_div


def _cells(df: DataFrame, label: str, pred: str) -> DataFrame:
    y = F.coalesce(F.col(label).cast("boolean"), F.lit(False))
    p = F.coalesce(F.col(pred).cast("boolean"), F.lit(False))
    return df.agg(F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
                  F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"))


def confusion_cells(df: DataFrame, label: str = "label", pred: str = "is_anomaly") -> DataFrame:
    c = _cells(df, label, pred)
    stacked = c.select(F.expr("stack(4, false, false, tn, false, true, fp, true, false, fn, true, true, tp)")
                       .alias("label", "prediction", "count"))
    return stacked


def _div0(a: Column, b: Column) -> Column:
    return F.coalesce(safe_div(a.cast("double"), b.cast("double")), F.lit(0.0))


def report_from_cells(c: DataFrame) -> DataFrame:
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1 = _div0(tp, tp + fp), _div0(tp, tp + fn)
    p0, r0 = _div0(tn, tn + fn), _div0(tn, tn + fp)
    f1 = _div0(2 * p1 * r1, p1 + r1)
    f0 = _div0(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    return c.select(
        _div0(p0 * s0 + p1 * s1, n).alias("precision"),
        _div0(r0 * s0 + r1 * s1, n).alias("recall"),
        _div0(f0 * s0 + f1 * s1, n).alias("f1_score"),
        _div0(tn + tp, n).alias("accuracy"),
        F.array(F.array(tn, fp), F.array(fn, tp)).alias("confusion_matrix"),
        n.alias("support"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "is_anomaly") -> DataFrame:
    return report_from_cells(_cells(df, label, pred))


def unlabelled_metrics(df: DataFrame, pred: str = "is_anomaly", score: str = "anomaly_score") -> DataFrame:
    return df.agg(F.avg(F.coalesce(F.col(pred), F.lit(False)).cast("double")).alias("anomaly_rate"),
                  F.avg(score).alias("avg_score"), F.stddev_pop(score).alias("score_std"))


def evaluate(results: DataFrame, label: str | None, pred: str = "is_anomaly",
             score: str = "anomaly_score") -> DataFrame:
    """Labelled metrics when ``label`` is a column of ``results``, else unlabelled ones."""
    if label and label in results.columns:
        return classification_report(results, label, pred)
    return unlabelled_metrics(results, pred, score)
