"""Labelled-anomaly injection for back-testing.

Each row independently becomes an anomaly with probability ``rate``; the kind
is uniform among spike ``+U(20, 50)``, drop ``-U(20, 50)`` and drift
``+U(-30, 30)``.  Randomness is md5 of ``(id, seed, salt)``, so the result is
repeatable, row-parallel and independent of partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import md5_unit

# fixed values of the generator: anomaly share, kinds and their ranges
ANOMALY_RATE = 0.05
SPIKE = (20.0, 50.0)
DROP = (20.0, 50.0)
DRIFT = (-30.0, 30.0)


def inject_anomalies(df: DataFrame, id_col: str, value: str = "value", rate: float = ANOMALY_RATE,
                     seed: int = 42, out_label: str = "is_anomaly") -> DataFrame:
    """Returns the input with ``value`` replaced (rounded to 2 places),
    ``out_label``, ``anomaly_kind`` and ``normal_value`` (NULL for normal rows)."""
    s = F.lit(str(seed))
    u_hit = md5_unit(id_col, s, F.lit("hit"))
    u_kind = md5_unit(id_col, s, F.lit("kind"))
    u_mag = md5_unit(id_col, s, F.lit("mag"))
    hit = u_hit < F.lit(rate)
    kind = F.when(u_kind < 1.0 / 3.0, F.lit("spike")).when(u_kind < 2.0 / 3.0, F.lit("drop")).otherwise("drift")
    delta = (F.when(kind == "spike", SPIKE[0] + (SPIKE[1] - SPIKE[0]) * u_mag)
             .when(kind == "drop", -(DROP[0] + (DROP[1] - DROP[0]) * u_mag))
             .otherwise(DRIFT[0] + (DRIFT[1] - DRIFT[0]) * u_mag))
    v = F.col(value)
    return df.withColumns({
        "normal_value": F.when(hit, F.round(v, 2)),
        "anomaly_kind": F.when(hit, kind),
        out_label: hit,
        value: F.round(F.when(hit, v + delta).otherwise(v), 2),
    })


def union_labelled(normal: DataFrame, anomalous: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """Concatenate a normal and an anomalous sample with literal labels."""
    return (normal.withColumn(label, F.lit(False))
            .unionByName(anomalous.withColumn(label, F.lit(True))))
