"""In-memory inputs -> DataFrames (small, driver-side values only).

Accepts what the original detectors accepted for a single call: a dict
(``value`` -> ``data`` -> 0), a list / tuple / numpy array / pandas Series
(one row per element; a 2-D array is flattened to one column, as before), or
a scalar.  For tables use ``spark.read`` / ``tidemark.sources.tables``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def as_frame(spark: SparkSession, data, value: str = "value", id_col: str = "id") -> DataFrame:
    if isinstance(data, dict):
        v = data.get("value", data.get("data", 0))
        vals = [v]
    elif hasattr(data, "tolist") and not isinstance(data, (str, bytes)):
        vals = list(_flat(data.tolist()))
    elif isinstance(data, (list, tuple)):
        vals = list(_flat(list(data)))
    else:
        vals = [data]
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, f"{id_col} long, {value} double")


def _flat(x):
    for e in x:
        if isinstance(e, (list, tuple)):
            yield from _flat(e)
        else:
            yield e
