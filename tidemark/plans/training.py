"""Train, evaluate, tune and select detectors.

* ``train_model``   fit one detector (timed), evaluate on optional validation rows
* ``train_many``    several detector types; a failing type is recorded, the rest go on
* ``grid_search``   expanding-window (time-ordered) folds, binary f1 per fold
* ``auto_select``   best f1 (strict, first in list order wins ties)

Every step is Spark jobs over whole tables; only one metrics row per trained
model comes back to the driver.  A statistical (rolling) detector fitted on
the rows before a fold scores the fold exactly as one rolling pass over the
whole series does, so its grid search scores ALL parameter sets with one
window pass (one frame per window size) and one aggregate over the folds.
"""

from __future__ import annotations

import itertools
import json
import time
from datetime import datetime, timezone
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.base import SeriesSpec
from tidemark.operators.ensemble import create_detector
from tidemark.operators.evaluate import evaluate
from tidemark.operators.split import with_positions, fold_bounds
from tidemark.session import materialize

DEFAULT_TYPES = ("isolation_forest", "statistical", "ensemble")

RESULT_SCHEMA = T.StructType([
    T.StructField("trial_order", T.IntegerType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("training_time", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1_score", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("anomaly_rate", T.DoubleType()),
    T.StructField("avg_score", T.DoubleType()),
    T.StructField("score_std", T.DoubleType()),
    T.StructField("config", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("error", T.StringType()),
])


def prepare(df: DataFrame, spec: SeriesSpec, label_column: str = "is_anomaly",
            feature_columns: Sequence[str] | None = None) -> tuple[DataFrame, bool]:
    """Project the series columns, the features and the label (if present)."""
    feats = list(feature_columns or [spec.value])
    cols = list(dict.fromkeys([*spec.keys, *spec.order, *( [spec.id] if spec.id else []), *feats]))
    has_label = label_column in df.columns
    if has_label:
        cols.append(label_column)
    return df.select(*cols), has_label


def evaluate_model(model, test: DataFrame, label_column: str = "is_anomaly") -> DataFrame:
    """Score the test rows (a rolling model continues from its fitted history)
    and return one metrics row (labelled or unlabelled metrics)."""
    if label_column in test.columns:
        # the prediction is also called is_anomaly: keep the truth under its own name
        scored = model.transform(test.withColumnRenamed(label_column, "_label"))
        return evaluate(scored, "_label")
    return evaluate(model.transform(test), None)


def _cfg_key(model_type: str, config: dict | None) -> tuple[str, str]:
    return model_type, json.dumps(config or {}, sort_keys=True, default=str)


def train_model(model_type: str, train: DataFrame, validation: DataFrame | None = None,
                config: dict | None = None, spec: SeriesSpec = SeriesSpec(), label_column: str = "is_anomaly",
                fitted: dict | None = None):
    """Returns ``(model, result_dict)``.  ``fitted`` maps (type, config) to models
    already fitted on the same training rows; an ensemble reuses those members."""
    det = create_detector(model_type, config or {}, spec)
    tr, _ = prepare(train, spec, label_column)
    data = tr.drop(label_column) if label_column in tr.columns else tr
    t0 = time.time()
    if model_type == "ensemble" and fitted:
        members = {}
        for name, mcfg in (config or {}).get("detectors", {}).items():
            mcfg = dict(mcfg or {})
            key = _cfg_key(mcfg.pop("type", name), mcfg)
            if key in fitted:
                members[name] = fitted[key]
        model = det.fit(data, prefit=members)
    else:
        model = det.fit(data)
    training_time = time.time() - t0
    res = {"model_type": model_type, "training_time": training_time,
           "config": json.dumps(config or {}, sort_keys=True, default=str),
           "timestamp": datetime.now(timezone.utc).isoformat()}
    if validation is not None:
        va, _ = prepare(validation, spec, label_column)
        m = evaluate_model(model, va, label_column).first().asDict()
        m.pop("confusion_matrix", None)
        m.pop("support", None)
        res.update(m)
    return model, res


def train_many(spark: SparkSession, train: DataFrame, validation: DataFrame | None = None,
               model_types: Sequence[str] = DEFAULT_TYPES, configs: dict | None = None,
               spec: SeriesSpec = SeriesSpec(), label_column: str = "is_anomaly"):
    """Results table (one row per type, ``error`` set when a type failed) and the models."""
    rows, models, fitted = [], {}, {}
    for i, mt in enumerate(model_types):
        try:
            cfg = (configs or {}).get(mt, {})
            model, res = train_model(mt, train, validation, cfg, spec, label_column, fitted)
            models[mt] = model
            fitted[_cfg_key(mt, cfg)] = model
            res["error"] = None
        except Exception as e:  # noqa: BLE001 - a failing type must not stop the others
            res = {"model_type": mt, "error": f"{type(e).__name__}: {e}"}
        res["trial_order"] = i
        rows.append(tuple(res.get(f.name) for f in RESULT_SCHEMA.fields))
    return spark.createDataFrame(rows, RESULT_SCHEMA), models


def auto_select(results: DataFrame) -> DataFrame:
    """Best model by f1 (a model without labels counts as f1 0; errors are skipped);
    ties keep the earlier trial.  Empty when every model failed."""
    ok = results.where(F.col("error").isNull())
    ranked = ok.select("model_type", F.coalesce("f1_score", F.lit(0.0)).alias("best_score"), "trial_order")
    return ranked.orderBy(F.col("best_score").desc(), F.col("trial_order").asc()).limit(1) \
        .select(F.col("model_type").alias("best_model"), "best_score")


def _binary_f1(scored: DataFrame, label: str, pred: str = "is_anomaly", by: Sequence[str] = ()) -> DataFrame:
    y, p = F.coalesce(F.col(label).cast("boolean"), F.lit(False)), F.coalesce(F.col(pred), F.lit(False))
    tp, fp, fn = F.count_if(y & p), F.count_if(~y & p), F.count_if(y & ~p)
    g = scored.groupBy(*by) if by else scored.groupBy()
    out = g.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return out.withColumn("f1", F.when(den > 0, 2 * F.col("tp") / den).otherwise(0.0)).drop("tp", "fp", "fn")


def _statistical_grid(pos: DataFrame, combos: list[dict], spec: SeriesSpec, label: str, fold, base: dict):
    """All parameter combinations of the rolling detector in ONE window pass:
    every window size is its own frame over the same window specification (one
    exchange, one sort), every combination's flag is a column, and one
    aggregate per fold counts tp / fp / fn for all combinations."""
    from tidemark.operators.rolling import RN, over_series
    from tidemark.operators.statistical import StatisticalDetector, clean, iqr_columns, zscore_columns
    from tidemark.functions.exprs import sorted_quantile
    reading = clean(pos, spec.value)  # NaN is no reading, as in the detector this tunes
    dets = [StatisticalDetector(spec, **{**base, **c}) for c in combos]
    sizes = sorted({d.window_size for d in dets})

    def cols(w):
        out = {}
        v = reading
        for W in sizes:
            fr = w.rowsBetween(-(W - 1), -1)
            if any(d.method != "iqr" and d.window_size == W for d in dets):
                out[f"_m{W}"], out[f"_sd{W}"] = F.avg(v).over(fr), F.stddev_pop(v).over(fr)
            if any(d.method == "iqr" and d.window_size == W for d in dets):
                out[f"_q{W}"] = F.sort_array(F.collect_list(v).over(fr))
        return out

    scored = over_series(pos, spec.keys, spec.order, cols, halo_before=max(sizes) - 1,
                         hot_key_rows=dets[0].hot_key_rows, chunk_rows=dets[0].chunk_rows)
    v = reading
    flags = {}
    for ci, d in enumerate(dets):
        W = d.window_size
        if d.method == "iqr":
            flag, _ = iqr_columns(v, sorted_quantile(f"_q{W}", 0.25), sorted_quantile(f"_q{W}", 0.75), d.threshold)
        else:
            flag, _ = zscore_columns(v, F.col(f"_m{W}"), F.col(f"_sd{W}"), d.threshold)
        flags[ci] = F.when((F.col(RN) - 1) >= d.min_history, flag).otherwise(F.lit(False))
    y = F.coalesce(F.col(label).cast("boolean"), F.lit(False))
    aggs = []
    for ci, fl in flags.items():
        aggs += [F.count_if(y & fl).alias(f"tp{ci}"), F.count_if(~y & fl).alias(f"fp{ci}"),
                 F.count_if(y & ~fl).alias(f"fn{ci}")]
    per_fold = scored.withColumn("fold", fold).where(F.col("fold").isNotNull()).groupBy("fold").agg(*aggs)
    # unpivot the (folds x combinations) counts: a small table
    entries = F.array(*[F.struct(F.lit(ci).alias("combo"), F.lit(json.dumps(c, sort_keys=True)).alias("params"),
                                 F.col(f"tp{ci}").alias("tp"), F.col(f"fp{ci}").alias("fp"),
                                 F.col(f"fn{ci}").alias("fn")) for ci, c in enumerate(combos)])
    long = per_fold.select("fold", F.explode(entries).alias("e")).select("e.combo", "e.params", "fold",
                                                                         "e.tp", "e.fp", "e.fn")
    den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return long.select("combo", "params", "fold", F.when(den > 0, 2 * F.col("tp") / den).otherwise(0.0).alias("f1"))


def grid_search(spark: SparkSession, model_type: str, df: DataFrame, param_grid: dict[str, list],
                spec: SeriesSpec, label_column: str = "is_anomaly", n_splits: int = 5,
                base_config: dict | None = None) -> tuple[DataFrame, dict]:
    """Cross-validated f1 per parameter set over expanding time-ordered folds.

    Returns (cv results: params, fold, f1; best: {best_params, best_score})."""
    if label_column == "is_anomaly":
        df = df.withColumnRenamed("is_anomaly", "_label")
        label_column = "_label"
    names = sorted(param_grid)
    combos = [dict(zip(names, vals)) for vals in itertools.product(*[param_grid[n] for n in names])]
    pos = materialize(with_positions(df, list(spec.order)), "folds")
    n = pos.count()
    if n <= n_splits:
        raise ValueError(f"{n} rows cannot be cut into {n_splits} folds and a first training part")
    bounds = fold_bounds(n, n_splits)
    first, t = bounds[0][1], bounds[0][2] - bounds[0][1]
    fold = F.when(F.col("_pos") >= first, F.floor((F.col("_pos") - first) / t)).cast("int")
    parts = []
    if model_type == "statistical":
        parts.append(_statistical_grid(pos, combos, spec, label_column, fold, base_config or {}))
    else:
        for ci, params in enumerate(combos):
            cfg = {**(base_config or {}), **params}
            ptxt = json.dumps(params, sort_keys=True)
            for i, s, e in bounds:
                det = create_detector(model_type, cfg, spec)
                model = det.fit(pos.where(F.col("_pos") < s).drop(label_column))
                test = pos.where((F.col("_pos") >= s) & (F.col("_pos") < e))
                f1 = _binary_f1(model.transform(test), label_column)
                parts.append(f1.select(F.lit(ci).alias("combo"), F.lit(ptxt).alias("params"),
                                       F.lit(i).alias("fold"), "f1"))
    cv = parts[0]
    for p in parts[1:]:
        cv = cv.unionByName(p)
    summary = cv.groupBy("combo", "params").agg(F.avg("f1").alias("mean_f1"))
    best = summary.orderBy(F.col("mean_f1").desc(), F.col("combo").asc()).first()
    return cv, {"best_params": json.loads(best["params"]), "best_score": best["mean_f1"]}
