"""Model tables and a versioned registry.

A fitted model is written as parquet tables under ``<root>/<model_id>/``:
``params`` (one row: type, creation time, scalar parameters as JSON) plus the
model's own bounded tables (isolation-forest intervals, LOF training table,
statistical history, a baseline's parameters).  An ensemble is its members' ids,
weights and threshold; the members lie under ``<root>/_members``.  The registry index ``<root>/_index`` has one row per
saved model; ``latest`` keeps the newest row per model type with
``row_number()`` (a window partitioned by type over the small index).
"""

from __future__ import annotations

import json
import os
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.base import SeriesSpec
from tidemark.operators.ensemble import EnsembleModel
from tidemark.operators.isolation_forest import IsolationForestModel
from tidemark.operators.lof import LOFModel
from tidemark.operators.ocsvm import OneClassSVMModel
from tidemark.operators.rolling import DEFAULT_HOT_KEY_ROWS
from tidemark.operators.statistical import StatisticalModel
from tidemark.streaming.scoring import BaselineModel

INDEX_SCHEMA = T.StructType([
    T.StructField("model_id", T.StringType()), T.StructField("model_type", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("created_at", T.TimestampType()),
    T.StructField("params", T.StringType()), T.StructField("path", T.StringType()),
])


def _spec_dict(spec: SeriesSpec) -> dict:
    return {"keys": list(spec.keys), "order": list(spec.order), "value": spec.value, "id": spec.id}


def model_params(model) -> tuple[str, dict, dict[str, DataFrame]]:
    """(type, scalar parameters, tables) of a fitted model."""
    if isinstance(model, IsolationForestModel):
        return ("isolation_forest", {"mean": model.mean, "sd": model.sd, "threshold": model.threshold,
                                     "splits": model.splits, **model.params}, {"intervals": model.intervals})
    if isinstance(model, LOFModel):
        return ("lof", {"mean": model.mean, "sd": model.sd, "k": model.k, "n": model.n, "offset": model.offset,
                        "chunk_rows": model.chunk_rows}, {"train": model.train})
    if isinstance(model, OneClassSVMModel):
        return ("one_class_svm", {"mean": model.mean, "sd": model.sd, "W": list(map(float, model.W)),
                                  "B": list(map(float, model.B)), "w": list(map(float, model.w)),
                                  "rho": model.rho, **model.params}, {})
    if isinstance(model, StatisticalModel):
        tables = {"history": model.history} if model.history is not None else {}
        return ("statistical", {"method": model.method, "threshold": model.threshold,
                                "window_size": model.window_size, "min_history": model.min_history,
                                "has_history": bool(tables)}, tables)
    if isinstance(model, BaselineModel):
        return ("baseline", {"keys": model.keys, "value": model.value, "threshold": model.threshold, "small": model.small},
                {"params": model.params})
    raise TypeError(f"cannot save {type(model).__name__}")


def save_model(spark: SparkSession, model, root: str, name: str | None = None) -> str:
    """Write a fitted model; an ensemble's members are written first, as models of their own that only it names."""
    if isinstance(model, EnsembleModel):
        members = {m: save_model(spark, part, os.path.join(root, "_members"), m) for m, part in model.members.items()}
        mtype, params, tables = "ensemble", {"members": members, "weights": model.weights, "threshold": model.threshold,
                                             "compat": model.compat}, {}
    else:
        mtype, params, tables = model_params(model)
    if hasattr(model, "spec"):
        params["spec"] = _spec_dict(model.spec)
    model_id = f"{name or mtype}_{datetime.now(timezone.utc).strftime('%Y%m%d_%H%M%S')}_{uuid.uuid4().hex[:8]}"
    path = os.path.join(root, model_id)
    for tname, tdf in tables.items():
        tdf.write.mode("overwrite").parquet(os.path.join(path, tname))
    row = (model_id, mtype, name or mtype, datetime.now(timezone.utc).replace(tzinfo=None),
           json.dumps(params, default=float), path)
    spark.createDataFrame([row], INDEX_SCHEMA).write.mode("append").parquet(os.path.join(root, "_index"))
    return model_id


def index(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(os.path.join(root, "_index"))


def latest(spark: SparkSession, root: str) -> DataFrame:
    """Newest saved model per name, with its version number (1 = first)."""
    idx = index(spark, root)
    w_new = Window.partitionBy("name").orderBy(F.col("created_at").desc(), F.col("model_id").desc())
    w_old = Window.partitionBy("name").orderBy("created_at", "model_id")
    return (idx.withColumn("_r", F.row_number().over(w_new)).withColumn("version", F.row_number().over(w_old))
            .where("_r = 1").drop("_r"))


def load_model(spark: SparkSession, root: str, model_id: str):
    r = index(spark, root).where(F.col("model_id") == model_id).first()
    if r is None:
        raise KeyError(model_id)
    p = json.loads(r["params"])
    if r["model_type"] == "ensemble":
        members = {m: load_model(spark, os.path.join(root, "_members"), i) for m, i in p["members"].items()}
        return EnsembleModel(members, p["weights"], p["threshold"], p["compat"])
    if r["model_type"] == "baseline":
        return BaselineModel(spark.read.parquet(os.path.join(r["path"], "params")), p["keys"], p["value"], p["threshold"], p["small"])
    s = p.pop("spec")
    spec = SeriesSpec(tuple(s["keys"]), tuple(s["order"]), s["value"], s["id"])
    if r["model_type"] == "isolation_forest":
        iv = spark.read.parquet(os.path.join(r["path"], "intervals"))
        extra = {k: p[k] for k in ("n_estimators", "max_samples", "seed", "contamination", "n_train") if k in p}
        return IsolationForestModel(spec, p["mean"], p["sd"], iv, p["splits"], p["threshold"], extra)
    if r["model_type"] == "lof":
        tr = spark.read.parquet(os.path.join(r["path"], "train"))
        return LOFModel(spec, p["mean"], p["sd"], p["k"], p["n"], p["offset"], tr, p["chunk_rows"])
    if r["model_type"] == "one_class_svm":
        import numpy as np
        return OneClassSVMModel(spec, p["mean"], p["sd"], np.array(p["W"]), np.array(p["B"]), np.array(p["w"]),
                                p["rho"], {k: p[k] for k in ("nu", "gamma", "n_components", "n_train") if k in p})
    hist = spark.read.parquet(os.path.join(r["path"], "history")) if p.get("has_history") else None
    return StatisticalModel(spec, p["method"], p["threshold"], p["window_size"], p["min_history"], hist,
                            DEFAULT_HOT_KEY_ROWS, 1_000_000)


def load_latest(spark: SparkSession, root: str, name: str):
    r = latest(spark, root).where(F.col("name") == name).first()
    if r is None:
        raise KeyError(name)
    return load_model(spark, root, r["model_id"])
