"""Scaling and feature engineering.

``StandardScaler`` here uses the **population** std (zero std -> 1), unlike
``pyspark.ml.feature.StandardScaler`` which uses the sample std.  Parameters
are a table with one row per key (or one global row); applying them is a
join on the key, broadcast only when the table is known to be small.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rolling import RN, over_series, DEFAULT_HOT_KEY_ROWS

BROADCAST_ROWS = 100_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                   broadcast: bool = False) -> DataFrame:
    """Join on ``keys`` where NULL matches NULL (a NULL key is a group too);
    the result keeps the left key columns once."""
    keys = list(keys)
    ren = {k: f"_rk_{k}" for k in keys}
    r = right.withColumnsRenamed(ren)
    if broadcast:
        r = F.broadcast(r)
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[ren[k]])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*ren.values())


def join_params(df: DataFrame, params: DataFrame, keys: Sequence[str], limit: int = BROADCAST_ROWS) -> DataFrame:
    """Attach a per-key parameter table.  No keys: the single global row is read
    as literals.  Keys: broadcast join only after checking the table size;
    NULL keys match (null-safe equality)."""
    keys = list(keys)
    if not keys:
        r = params.first()
        if r is None:
            raise ValueError("empty parameter table")
        return df.withColumns({c: F.lit(r[c]) for c in params.columns})
    n = params.count()
    return null_safe_join(df, params, keys, "left", broadcast=n <= limit)


class ScalerModel:
    def __init__(self, params: DataFrame, keys: Sequence[str], value: str, kind: str):
        self.params, self.keys, self.value, self.kind = params, list(keys), value, kind

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        out = out or f"{self.value}_scaled"
        j = join_params(df, self.params, self.keys)
        v = F.col(self.value)
        if self.kind == "standard":
            sd = F.when((F.col("_sd") == 0) | F.col("_sd").isNull(), F.lit(1.0)).otherwise(F.col("_sd"))
            expr = (v - F.col("_mean")) / sd
            drop = ["_mean", "_sd"]
        else:
            rng = F.col("_max") - F.col("_min")
            expr = F.when(rng == 0, F.lit(0.0)).otherwise((v - F.col("_min")) / rng)
            drop = ["_min", "_max"]
        return j.withColumn(out, expr).drop(*drop)


def fit_standard(df: DataFrame, value: str = "value", keys: Sequence[str] = ()) -> ScalerModel:
    g = df.groupBy(*keys) if keys else df.groupBy()
    p = g.agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_sd"))
    return ScalerModel(p, keys, value, "standard")


def fit_minmax(df: DataFrame, value: str = "value", keys: Sequence[str] = ()) -> ScalerModel:
    g = df.groupBy(*keys) if keys else df.groupBy()
    p = g.agg(F.min(value).alias("_min"), F.max(value).alias("_max"))
    return ScalerModel(p, keys, value, "minmax")


def rolling_features(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "value",
                     window_size: int = 100, time_col: str | None = None,
                     hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS) -> DataFrame:
    """Per row: previous value, difference, rolling mean / population std over
    the previous ``window_size - 1`` rows, and hour-of-day sin / cos."""

    def cols(w) -> dict[str, Column]:
        frame = w.rowsBetween(-(window_size - 1), -1)
        v = F.col(value)
        return {"prev_value": F.lag(v, 1).over(w),
                "roll_mean": F.avg(v).over(frame), "roll_std": F.stddev_pop(v).over(frame)}

    out = over_series(df, keys, order, cols, halo_before=window_size - 1, hot_key_rows=hot_key_rows)
    out = out.withColumn("diff", F.col(value) - F.col("prev_value"))
    if time_col:
        h = F.hour(time_col).cast("double")
        two_pi = 2.0 * 3.141592653589793
        out = out.withColumns({"hour_sin": F.sin(h * two_pi / 24.0), "hour_cos": F.cos(h * two_pi / 24.0)})
    return out.drop(RN)
