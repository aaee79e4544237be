"""Configuration: defaults of the original pipeline and a loader.

``load_config`` reads a YAML file or takes a dict, deep-merges it over the
defaults and returns the flat per-detector configuration used by
``create_detector`` (see ``operators.ensemble.flatten_config``).
"""

from __future__ import annotations

import copy

from tidemark.operators.ensemble import flatten_config

# fixed values: the original configuration's detector, streaming, training and alert settings
DEFAULTS = {
    "processing": {"window_size": 100, "batch_size": 1000, "checkpoint_interval": 10, "watermark_delay": 30},
    "anomaly_detection": {
        "method": "ensemble",
        "threshold": 0.8,
        "detectors": {
            "isolation_forest": {"contamination": 0.1, "n_estimators": 100, "random_state": 42},
            "lof": {"contamination": 0.1, "n_neighbors": 20},
            "one_class_svm": {"nu": 0.1, "kernel": "rbf", "gamma": "scale"},
            "statistical": {"method": "zscore", "threshold": 3.0, "window_size": 100},
        },
        "ensemble": {"weights": {"isolation_forest": 0.4, "lof": 0.3, "statistical": 0.3}, "threshold": 0.5},
    },
    "model_training": {
        "feature_columns": ["value"],
        "label_column": "is_anomaly",
        "train_test_split": 0.7,
        "validation_split": 0.2,
        "hyperparameter_tuning": {"enabled": True, "cv_folds": 5},
        "auto_ml": {"enabled": True, "model_types": ["isolation_forest", "statistical", "ensemble"]},
    },
    "monitoring": {"alerting": {"rules": [
        {"name": "high_anomaly_rate", "condition": "anomaly_rate > 0.1", "severity": "warning"},
        {"name": "service_down", "condition": "service_health == 0", "severity": "critical"},
    ]}},
}


def _merge(base: dict, over: dict) -> dict:
    out = copy.deepcopy(base)
    for k, v in (over or {}).items():
        out[k] = _merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def load_config(source: str | dict | None = None) -> dict:
    """Full configuration: defaults overlaid with a YAML file path or a dict."""
    if source is None:
        return copy.deepcopy(DEFAULTS)
    if isinstance(source, str):
        import yaml
        with open(source) as f:
            source = yaml.safe_load(f) or {}
    return _merge(DEFAULTS, source)


def detector_configs(cfg: dict) -> dict:
    """Per-detector configs (the ensemble gets its members, weights and threshold)."""
    return flatten_config(cfg)


def alert_rules(cfg: dict) -> list[tuple[str, str, str]]:
    rules = cfg.get("monitoring", {}).get("alerting", {}).get("rules", [])
    return [(r["name"], r["condition"], r.get("severity", "warning")) for r in rules]
