"""One-class SVM (RBF kernel) approximated with random Fourier features.

MLlib has no kernel one-class SVM, so the primal problem is solved on an
explicit feature map::

    phi_j(x) = sqrt(2/D) * cos(w_j * x + b_j),  w_j ~ N(0, 2*gamma), b_j ~ U(0, 2*pi)

    minimise 1/2 |w|^2 - rho + 1/(nu*n) * sum_i max(0, rho - w . phi(x_i))

on the exact standardised value (``gamma='scale'`` = 1 / (n_features * var) = 1).

The sub-gradient iterations are distributed: the standardised column is written
once, and each step is one pass over it in which every task returns D partial
sums (``sum of phi over the violators``) and a count, so the driver holds D + 1
numbers whatever the data size::

    w   <- w - eta_t (w - sum_viol phi / (nu n)),   eta_t = 1 / (t + 1)
    rho <- rho - eta_t (share of violators - nu)

The final ``rho`` is the exact ``nu``-quantile of ``w . phi`` (rank brackets),
so the flagged share of the training rows is ``nu`` whatever their spread.
Nothing is rounded or clamped.  Scoring is a pure column expression (D
cosines, whole-stage codegen).  Decision ``w . phi(x) - rho``; anomaly iff
``< 0``.  Not bit-equal to libsvm; the steps equal the same steps in SQL.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.base import Detector, Model, SeriesSpec, READINGS, with_detection, UnfittedModel
from tidemark.operators.quantile import exact_percentile
from tidemark.operators.scaling import fit_standard
from tidemark.session import materialize

#: rows whose features a task holds at once
CHUNK_ROWS = 16_384


def _phi(x: Column, W, B, D) -> list[Column]:
    s = math.sqrt(2.0 / D)
    return [F.lit(s) * F.cos(x * F.lit(float(W[j])) + F.lit(float(B[j]))) for j in range(D)]


def _dot(phis: list[Column], w) -> Column:
    out = F.lit(0.0)
    for p, c in zip(phis, w):
        out = out + p * F.lit(float(c))
    return out


def random_features(D: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and phases of the map."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, math.sqrt(2.0 * gamma), D), rng.uniform(0.0, 2.0 * math.pi, D)


def _sums(x: DataFrame, W: np.ndarray, B: np.ndarray, w: np.ndarray | None, rho: float) -> np.ndarray:
    """(sums of phi over the rows with ``w . phi < rho``, their number); over all rows without ``w``.
    Every task adds up its rows and returns one row."""
    D = len(W)

    def partial(batches):
        total = np.zeros(D + 1)
        for batch in batches:
            v = batch.column(0).to_numpy()
            for first in range(0, len(v), CHUNK_ROWS):
                phi = math.sqrt(2.0 / D) * np.cos(np.outer(v[first:first + CHUNK_ROWS], W) + B)
                if w is not None:
                    phi = phi[phi @ w < rho]
                total[:D] += phi.sum(axis=0)
                total[D] += len(phi)
        yield pa.record_batch([pa.array([c]) for c in total], [f"c{j}" for j in range(D + 1)])

    sums = x.mapInArrow(partial, ", ".join(f"c{j} double" for j in range(D + 1)))
    return np.array(sums.agg(*[F.sum(f"c{j}") for j in range(D + 1)]).first(), dtype=float)


class OneClassSVMModel(Model):
    kind = "one_class_svm"

    def __init__(self, spec, mean, sd, W, B, w, rho, params):
        self.spec, self.mean, self.sd, self.W, self.B, self.w, self.rho = spec, mean, sd, W, B, w, rho
        self.params = params

    def decision(self, df: DataFrame) -> Column:
        x = (F.col(self.spec.value).cast("double") - F.lit(self.mean)) / F.lit(self.sd or 1.0)
        return _dot(_phi(x, self.W, self.B, len(self.W)), self.w) - F.lit(self.rho)

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        out = df.withColumn("_dec", self.decision(df))
        d = F.col("_dec")
        out = with_detection(out, F.coalesce(d < 0, F.lit(False)),
                             F.coalesce(F.least(F.greatest(-d, F.lit(0.0)), F.lit(1.0)), F.lit(0.0)),
                             self.kind, prefix)
        return out.withColumn(f"{prefix}reference_score", 1.0 - d).drop("_dec")


class OneClassSVMDetector(Detector):
    name = "one_class_svm"

    def __init__(self, spec: SeriesSpec = READINGS, nu: float = 0.1, kernel: str = "rbf", gamma="scale",
                 n_components: int = 64, max_iter: int = 200, random_state: int = 42, tol: float = 1e-3, **_):
        super().__init__(spec)
        if kernel != "rbf":
            raise ValueError("only the rbf kernel is supported")
        self.nu, self.gamma, self.D = float(nu), gamma, int(n_components)
        self.max_iter, self.seed, self.tol = int(max_iter), int(random_state), float(tol)

    def fit(self, df: DataFrame) -> OneClassSVMModel:
        """Stops after ``max_iter`` steps, or when no weight moves by more than ``tol``.  NULL, NaN and
        infinite values are no readings."""
        spec = self.spec
        v = F.col(spec.value).cast("double")
        finite = df.select(v.alias(spec.value)).where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
        sc = fit_standard(finite, spec.value).params.first()
        if sc["_mean"] is None:
            raise ValueError("cannot fit a one-class SVM on no rows")
        mean, sd = float(sc["_mean"]), float(sc["_sd"] or 0.0)
        x = materialize(finite.select(((F.col(spec.value) - mean) / (sd or 1.0)).alias("x")), "svm-values")
        gamma = 1.0 if self.gamma in ("scale", "auto") else float(self.gamma)
        W, B = random_features(self.D, gamma, self.seed)
        first = _sums(x, W, B, None, 0.0)
        n, w = first[-1], first[:-1] / first[-1]
        rho = float(w @ w)
        for t in range(1, self.max_iter + 1):
            s = _sums(x, W, B, w, rho)
            eta = 1.0 / (t + 1.0)
            move = eta * (w - s[:-1] / (self.nu * n))
            w, rho = w - move, rho - eta * (s[-1] / n - self.nu)
            if np.abs(move).max() < self.tol:
                break
        f = _dot(_phi(F.col("x"), W, B, self.D), w)
        rho = float(exact_percentile(x.select(f.alias("f")), "f", self.nu).first()[0])
        return OneClassSVMModel(spec, mean, sd, W, B, w, rho,
                                {"nu": self.nu, "gamma": gamma, "n_components": self.D, "n_train": int(n), "steps": t if self.max_iter else 0})

    def unfitted(self):
        return UnfittedModel("unknown")
