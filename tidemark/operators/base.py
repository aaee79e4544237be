"""Detector contract.

``Detector.fit(df) -> Model`` and ``Model.transform(df) -> DataFrame``.  A
model keeps the input columns and appends

    is_anomaly boolean, anomaly_score double, anomaly_type string

(with an optional name prefix, used by the ensemble).  Fitted state is held
as DataFrames of bounded size (parameters, not data), so a model can be
written as tables (see ``tidemark.plans.registry``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SeriesSpec:
    """Which columns form a series: key, total order inside a key, value."""

    keys: Sequence[str] = ("source", "metric")
    order: Sequence[str] = ("timestamp",)
    value: str = "value"
    id: str | None = None  # a unique row id (hash sampling, joins back)

    def with_keys(self, *keys: str) -> "SeriesSpec":
        return SeriesSpec(tuple(keys), self.order, self.value, self.id)


READINGS = SeriesSpec(("source", "metric"), ("timestamp", "event_id"), "value", "event_id")


def out_names(prefix: str = "") -> tuple[str, str, str]:
    return f"{prefix}is_anomaly", f"{prefix}anomaly_score", f"{prefix}anomaly_type"


def with_detection(df: DataFrame, is_anomaly: Column, score: Column, kind, prefix: str = "") -> DataFrame:
    a, s, t = out_names(prefix)
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return df.withColumns({a: is_anomaly.cast("boolean"), s: score.cast("double"), t: kind.cast("string")})


class Model:
    kind = "unknown"

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:  # pragma: no cover
        raise NotImplementedError


class UnfittedModel(Model):
    """Result of using a detector before ``fit``: every row is normal."""

    def __init__(self, kind: str = "unknown"):
        self.kind = kind

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        return with_detection(df, F.lit(False), F.lit(0.0), self.kind, prefix)


class Detector:
    name = "detector"

    def __init__(self, spec: SeriesSpec = READINGS, **params):
        self.spec = spec
        self.params = params

    def fit(self, df: DataFrame) -> Model:  # pragma: no cover
        raise NotImplementedError

    def unfitted(self) -> Model:
        return UnfittedModel("unknown")


@dataclass
class FitInfo:
    """Small bookkeeping record kept by models (for registry rows)."""

    model_type: str
    params: dict = field(default_factory=dict)
