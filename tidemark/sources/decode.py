"""Message decoding: JSON text -> typed readings.

* ``decode_json``       ``from_json`` with a fixed schema (PERMISSIVE: a broken
                        message gives NULL fields and is flagged ``_corrupt``)
* ``flatten``           ``data.*``
* ``default_timestamp`` fill a missing timestamp with the ingest time
* ``value_chain``       ``value`` -> ``data`` -> 0.0 default chain
* ``encode_json``       key/value columns for a keyed message sink
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

READING = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("metric", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

LABELLED_READING = T.StructType(READING.fields + [
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("normal_value", T.DoubleType()),
])

ALERT = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("metric", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("anomaly_score", T.DoubleType()),
    T.StructField("anomaly_type", T.StringType()),
])


def decode_json(df: DataFrame, text_col: str = "value", schema: T.StructType = READING,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse ``text_col`` (string or binary) into a ``data`` struct.

    ``_corrupt`` is true when the text is not a JSON object at all.
    """
    text = F.col(text_col).cast("string")
    parsed = F.from_json(text, schema)
    valid_obj = F.coalesce(F.get_json_object(text, "$").isNotNull() & F.trim(text).startswith("{"), F.lit(False))
    return df.select(*keep, parsed.alias("data"), (~valid_obj).alias("_corrupt"))


def flatten(df: DataFrame, struct_col: str = "data") -> DataFrame:
    others = [c for c in df.columns if c != struct_col]
    return df.select(*others, f"{struct_col}.*")


def parse_timestamp(c: Column) -> Column:
    """ISO-8601 text (with or without zone / 'Z') -> TIMESTAMP; junk -> NULL."""
    return F.coalesce(F.try_to_timestamp(c), F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX")))


def default_timestamp(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """Readings without a timestamp get the ingest time."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return df.withColumn(col, F.coalesce(F.col(col), now))


def value_chain(df: DataFrame, value: str = "value", fallbacks: tuple[str, ...] = ("data",),
                default: float = 0.0) -> DataFrame:
    """``value`` -> first present fallback column -> ``default``."""
    cands = [F.col(value).cast("double")] + [F.col(f).cast("double") for f in fallbacks if f in df.columns]
    return df.withColumn(value, F.coalesce(*cands, F.lit(default)))


# microsecond timestamps (the JSON default keeps milliseconds only)
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def encode_json(df: DataFrame, key_col: str = "source") -> DataFrame:
    """``key`` (the source) and ``value`` (the whole row as JSON) for a keyed sink."""
    return df.select(F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).alias("value"))
