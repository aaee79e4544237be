"""Rolling z-score and IQR detectors (trailing, count-bounded buffers).

Semantics of the per-key buffer detector, expressed as window frames:

* a key's buffer holds at most ``window_size`` values including the current
  one, so statistics use the previous ``window_size - 1`` rows;
* a row is scored only when at least ``min_history`` (10) values precede it
  in its key (history rows from ``fit`` count); earlier rows are
  ``(false, 0.0, 'statistical')``;
* flagged values stay in the buffer;
* z-score: population std; std 0 -> ``(false, 0.0)``; anomaly iff
  ``|v - mean| / std > threshold``; score ``min(z / threshold, 1)``;
* IQR: exact linearly interpolated 25th / 75th percentiles (numpy rule); anomaly iff
  outside ``[q1 - t*iqr, q3 + t*iqr]``; score ``min(distance / iqr / t, 1)``,
  1.0 when iqr is 0; unknown methods fall back to z-score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import safe_div, sorted_quantile
from tidemark.operators.base import Detector, Model, SeriesSpec, READINGS, with_detection
from tidemark.operators.rolling import RN, over_series, DEFAULT_HOT_KEY_ROWS
from tidemark.session import materialize

READING = "_reading"
SEG = "_seg"  # 0 = history rows given to fit, 1 = rows to score


def clean(df: DataFrame, column: str) -> Column:
    """The column with NaN as NULL: neither is a reading, in a frame or as the value scored."""
    v = F.col(column)
    return F.when(~F.isnan(v), v) if dict(df.dtypes).get(column) in ("double", "float") else v


def zscore_columns(value: Column, mean: Column, sd: Column, threshold: float):
    """Flag and score.  A NULL or NaN z (no value, no usable spread) is not an
    anomaly and scores 0.0; ``least`` alone would turn it into 1.0."""
    z = F.abs(safe_div(value - mean, sd))
    usable = F.coalesce((sd != 0) & ~F.isnan(sd) & z.isNotNull() & ~F.isnan(z), F.lit(False))
    return (F.when(usable, z > F.lit(threshold)).otherwise(F.lit(False)),
            F.when(usable, F.least(z / F.lit(threshold), F.lit(1.0))).otherwise(F.lit(0.0)))


def iqr_columns(value: Column, q1: Column, q3: Column, threshold: float):
    iqr = q3 - q1
    lower = q1 - F.lit(threshold) * iqr
    upper = q3 + F.lit(threshold) * iqr
    is_anom = (value < lower) | (value > upper)
    dist = F.when(value < lower, safe_div(lower - value, iqr)).otherwise(safe_div(value - upper, iqr))
    # iqr == 0 divides by zero: the buffer detector scores that as 1.0
    score = F.when(is_anom, F.coalesce(F.least(dist / F.lit(threshold), F.lit(1.0)), F.lit(1.0))).otherwise(0.0)
    return F.coalesce(is_anom, F.lit(False)), F.coalesce(score, F.lit(0.0))


class StatisticalModel(Model):
    def __init__(self, spec: SeriesSpec, method: str, threshold: float, window_size: int,
                 min_history: int, history: DataFrame | None, hot_key_rows, chunk_rows):
        self.spec, self.method, self.threshold = spec, method, threshold
        self.window_size, self.min_history, self.history = window_size, min_history, history
        self.hot_key_rows, self.chunk_rows = hot_key_rows, chunk_rows
        self.kind = "iqr" if method == "iqr" else "zscore"

    def _frame_columns(self, v: Column, w: Window) -> dict[str, Column]:
        frame = w.rowsBetween(-(self.window_size - 1), -1)
        if self.kind == "iqr":
            # exact quartiles from the sorted frame (one native sort per row,
            # cheaper than the hash-map buffer of a sliding ``percentile``)
            return {"_q": F.sort_array(F.collect_list(v).over(frame))}
        return {"_m": F.avg(v).over(frame), "_sd": F.stddev_pop(v).over(frame)}

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        spec = self.spec
        order = list(spec.order)
        data = df
        if self.history is not None:
            # history rows precede the new rows of their key (seeded buffer)
            hist = self.history.select(*[c for c in df.columns if c in self.history.columns])
            data = (hist.withColumn(SEG, F.lit(0))
                    .unionByName(df.withColumn(SEG, F.lit(1)), allowMissingColumns=True))
            order = [SEG] + order
        # the guard runs once per row, not once per frame it falls into
        data, v = data.withColumn(READING, clean(df, spec.value)), F.col(READING)
        out = over_series(data, spec.keys, order, lambda w: self._frame_columns(v, w),
                          halo_before=self.window_size - 1,
                          hot_key_rows=self.hot_key_rows, chunk_rows=self.chunk_rows)
        if self.kind == "iqr":
            flag, score = iqr_columns(v, sorted_quantile("_q", 0.25), sorted_quantile("_q", 0.75), self.threshold)
        else:
            flag, score = zscore_columns(v, F.col("_m"), F.col("_sd"), self.threshold)
        warm = (F.col(RN) - 1) >= self.min_history
        out = with_detection(out,
                             F.when(warm, flag).otherwise(F.lit(False)),
                             F.when(warm, score).otherwise(F.lit(0.0)),
                             F.when(warm, F.lit(self.kind)).otherwise(F.lit("statistical")),
                             prefix)
        if self.history is not None:
            out = out.where(F.col(SEG) == 1).drop(SEG)
        return out.drop(RN, READING, "_m", "_sd", "_q")


class StatisticalDetector(Detector):
    """Rolling z-score / IQR per series key (H1)."""

    name = "statistical"

    def __init__(self, spec: SeriesSpec = READINGS, method: str = "zscore", threshold: float = 3.0,
                 window_size: int = 100, min_history: int = 10,
                 hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS, chunk_rows: int = 1_000_000, **_):
        super().__init__(spec)
        if window_size < 2:
            raise ValueError("window_size must be at least 2")
        self.method, self.threshold = method, float(threshold)
        self.window_size, self.min_history = int(window_size), int(min_history)
        self.hot_key_rows, self.chunk_rows = hot_key_rows, chunk_rows

    def fit(self, history: DataFrame | None = None) -> StatisticalModel:
        """``history`` preloads each key's buffer (it is not scored).  Of each key's history only the rows that a
        frame or the gate can reach are kept: the last ``window_size - 1``, or ``min_history`` if that is more."""
        if history is not None:
            newest = Window.partitionBy(*self.spec.keys).orderBy(*[F.col(c).desc() for c in self.spec.order])
            reach = max(self.window_size - 1, self.min_history)
            history = materialize(history.withColumn(RN, F.row_number().over(newest)).where(F.col(RN) <= reach).drop(RN), "history")
        return StatisticalModel(self.spec, self.method, self.threshold, self.window_size,
                                self.min_history, history, self.hot_key_rows, self.chunk_rows)

    def model(self) -> StatisticalModel:
        """A model with empty buffers: the first ``min_history`` rows of a key warm it up."""
        return self.fit(None)

    def unfitted(self):
        from tidemark.operators.base import UnfittedModel
        return UnfittedModel("statistical")


def rolling_zscore(df: DataFrame, spec: SeriesSpec, window_size: int = 100, threshold: float = 3.0,
                   min_history: int = 10, **kw) -> DataFrame:
    return StatisticalDetector(spec, "zscore", threshold, window_size, min_history, **kw).model().transform(df)


def rolling_iqr(df: DataFrame, spec: SeriesSpec, window_size: int = 100, threshold: float = 3.0,
                min_history: int = 10, **kw) -> DataFrame:
    return StatisticalDetector(spec, "iqr", threshold, window_size, min_history, **kw).model().transform(df)
