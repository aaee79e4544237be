import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from tidemark.config import alert_rules, detector_configs, load_config
from tidemark.operators.base import SeriesSpec
from tidemark.operators.evaluate import classification_report
from tidemark.operators.split import hash_split
from tidemark.plans.training import auto_select, grid_search, train_many


def _labelled(spark):
    """900 N(50, 10) normal and 100 N(100, 5) anomalous values with labels."""
    rng = np.random.RandomState(42)
    vals = np.concatenate([rng.normal(50, 10, 900), rng.normal(100, 5, 100)])
    lab = np.concatenate([np.zeros(900, bool), np.ones(100, bool)])
    perm = rng.permutation(1000)
    rows = [(int(i), float(vals[p]), bool(lab[p])) for i, p in enumerate(perm)]
    df = spark.createDataFrame(rows, "id long, value double, is_anomaly boolean")
    return df.withColumn("source", F.lit("sensor_01"))


def test_train_many_and_auto_select(spark):
    spec = SeriesSpec(("source",), ("id",), "value", "id")
    data = hash_split(_labelled(spark), "id", 0.7)
    cfg = detector_configs(load_config())
    cfg["ensemble"]["detectors"].pop("lof")
    res, models = train_many(spark, data.where("is_train").drop("is_train"),
                             data.where("not is_train").drop("is_train"),
                             ["isolation_forest", "statistical", "ensemble", "bogus"], cfg, spec)
    rows = {r.model_type: r for r in res.collect()}
    assert rows["bogus"].error.startswith("ValueError") and set(models) == {"isolation_forest", "statistical",
                                                                            "ensemble"}
    for m in ("isolation_forest", "statistical"):
        assert rows[m].error is None and rows[m].f1_score > 0.85, (m, rows[m])
    best = auto_select(res).first()
    f1s = {m: r.f1_score for m, r in rows.items() if r.error is None}
    assert best.best_score == max(f1s.values()) and f1s[best.best_model] == best.best_score


def test_grid_search_non_statistical(spark):
    spec = SeriesSpec(("source",), ("id",), "value", "id")
    cv, best = grid_search(spark, "isolation_forest", _labelled(spark), {"contamination": [0.05, 0.1]}, spec,
                           n_splits=3, base_config={"n_estimators": 20})
    assert cv.count() == 6 and best["best_params"]["contamination"] in (0.05, 0.1)


def test_report_matches_mllib_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rng = np.random.RandomState(3)
    rows = [(bool(a), bool(b)) for a, b in zip(rng.rand(500) < 0.2, rng.rand(500) < 0.3)]
    df = spark.createDataFrame(rows, "label boolean, is_anomaly boolean")
    ours = classification_report(df, "label").first()
    d = df.select(F.col("label").cast("double").alias("label"), F.col("is_anomaly").cast("double").alias("prediction"))
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert abs(ours.precision - ev.evaluate(d, {ev.metricName: "weightedPrecision"})) < 1e-12
    assert abs(ours.recall - ev.evaluate(d, {ev.metricName: "weightedRecall"})) < 1e-12
    assert abs(ours.f1_score - ev.evaluate(d, {ev.metricName: "f1"})) < 1e-12
    assert abs(ours.accuracy - ev.evaluate(d, {ev.metricName: "accuracy"})) < 1e-12


def test_config_loading(tmp_path=None):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "c.yaml")
    with open(p, "w") as f:
        f.write("anomaly_detection:\n  ensemble:\n    threshold: 0.6\n  detectors:\n    lof:\n      n_neighbors: 5\n")
    cfg = load_config(p)
    flat = detector_configs(cfg)
    assert flat["ensemble"]["threshold"] == 0.6 and flat["lof"]["n_neighbors"] == 5
    assert flat["isolation_forest"]["n_estimators"] == 100
    assert flat["ensemble"]["weights"] == {"isolation_forest": 0.4, "lof": 0.3, "statistical": 0.3}
    assert alert_rules(cfg)[0] == ("high_anomaly_rate", "anomaly_rate > 0.1", "warning")
