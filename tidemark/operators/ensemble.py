"""Weighted ensemble of detectors, and the detector factory.

The ensemble appends every member's detection under a prefix, then

    score = sum(w_m * score_m) / sum(w_m)     (0 when the weights sum to 0)
    is_anomaly = score > threshold            (strict; members' flags unused)
    detector_results = map(name -> struct(is_anomaly, score, type))

Members are ``isolation_forest``, ``lof`` and ``statistical`` by name; any
other member name may carry ``type`` (e.g. two statistical members, z-score
and IQR).  ``one_class_svm`` is not an ensemble member, as in the original.
``compat_scores=True`` feeds the original score scales (``1 + s`` for the
forest, ``1 - decision`` for LOF) into the weighted sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.base import Detector, Model, SeriesSpec, READINGS, with_detection, UnfittedModel, out_names
from tidemark.operators.isolation_forest import IsolationForestDetector
from tidemark.operators.lof import LOFDetector
from tidemark.operators.ocsvm import OneClassSVMDetector
from tidemark.operators.statistical import StatisticalDetector

MEMBER_TYPES = ("isolation_forest", "lof", "statistical")


class EnsembleModel(Model):
    kind = "ensemble"

    def __init__(self, members: dict[str, Model], weights: dict, threshold: float, compat: bool):
        self.members, self.weights, self.threshold, self.compat = members, weights, threshold, compat

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        out = df
        parts, wsum, entries = [], 0.0, []
        for name, m in self.members.items():
            p = f"_m_{name}_"
            out = m.transform(out, prefix=p)
            a, s, t = out_names(p)
            sc = F.col(s)
            if self.compat and f"{p}reference_score" in out.columns:
                sc = F.col(f"{p}reference_score")
            w = float(self.weights.get(name, 1.0))
            parts.append(sc * F.lit(w))
            wsum += w
            entries += [F.lit(name), F.struct(F.col(a).alias("is_anomaly"), sc.alias("score"),
                                              F.col(t).alias("type"))]
        total = F.lit(0.0)
        for x in parts:
            total = total + x
        score = total / F.lit(wsum) if wsum > 0 else F.lit(0.0)
        out = out.withColumn(f"{prefix}detector_results", F.create_map(*entries))
        out = with_detection(out, score > F.lit(self.threshold), score, "ensemble", prefix)
        drop = [c for c in out.columns if c.startswith("_m_")]
        return out.drop(*drop)


class EnsembleDetector(Detector):
    name = "ensemble"

    def __init__(self, spec: SeriesSpec = READINGS, detectors: dict | None = None, weights: dict | None = None,
                 threshold: float = 0.5, compat_scores: bool = False, **_):
        super().__init__(spec)
        self.detectors = {}
        for name, cfg in (detectors or {}).items():
            cfg = dict(cfg or {})
            typ = cfg.pop("type", name)
            if typ not in MEMBER_TYPES:
                continue
            self.detectors[name] = create_detector(typ, cfg, spec)
        self.weights = dict(weights or {})
        self.threshold, self.compat = float(threshold), bool(compat_scores)

    def fit(self, df: DataFrame, prefit: dict | None = None) -> EnsembleModel:
        """Fits every member on ``df`` (a statistical member takes it as buffer
        history); ``prefit`` supplies members already fitted on the same data."""
        prefit = prefit or {}
        members = {name: prefit[name] if name in prefit else d.fit(df) for name, d in self.detectors.items()}
        return EnsembleModel(members, self.weights, self.threshold, self.compat)

    def unfitted(self):
        return UnfittedModel("ensemble")


def create_detector(detector_type: str, config: dict | None = None, spec: SeriesSpec = READINGS) -> Detector:
    """Detector by name: isolation_forest, lof, one_class_svm, statistical, ensemble."""
    cfg = dict(config or {})
    table = {"isolation_forest": IsolationForestDetector, "lof": LOFDetector,
             "one_class_svm": OneClassSVMDetector, "statistical": StatisticalDetector,
             "ensemble": EnsembleDetector}
    if detector_type not in table:
        raise ValueError(f"Unknown detector type: {detector_type}")
    return table[detector_type](spec, **cfg)


def flatten_config(cfg: dict) -> dict:
    """Nested ``anomaly_detection`` section -> flat per-detector configs.

    ``detectors.<name>`` become member configs and ``ensemble.{weights,
    threshold}`` are lifted next to them for the ensemble."""
    ad = cfg.get("anomaly_detection", cfg)
    dets = dict(ad.get("detectors", {}))
    ens = dict(ad.get("ensemble", {}))
    out = {name: dict(c or {}) for name, c in dets.items()}
    out["ensemble"] = {"detectors": {k: v for k, v in dets.items() if k in MEMBER_TYPES},
                       "weights": ens.get("weights", {}), "threshold": ens.get("threshold", 0.5)}
    return out
