"""Bad-record isolation and schema enforcement.

A stream must not stop because one record is bad.  Instead of dropping such
records silently, rows are split by a validity predicate: good rows go on,
bad rows go to a quarantine table with a ``reason``.  Both sides come from
one projection, so Spark evaluates the reason once per row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def reading_reason(value: str = "value", ts: str = "timestamp", source: str = "source",
                   corrupt: str | None = "_corrupt") -> Column:
    """First failing rule of a reading, NULL when the reading is valid."""
    checks = []
    if corrupt:
        checks.append((F.coalesce(F.col(corrupt), F.lit(False)), "malformed_json"))
    checks += [
        (F.col(source).isNull(), "missing_source"),
        (F.col(value).isNull(), "missing_value"),
        (F.isnan(F.col(value)), "nan_value"),
        (F.col(ts).isNull(), "missing_timestamp"),
    ]
    out = F.lit(None).cast("string")
    for cond, reason in reversed(checks):
        out = F.when(cond, F.lit(reason)).otherwise(out)
    return out


def with_reason(df: DataFrame, reason: Column) -> DataFrame:
    return df.withColumn("reason", reason)


def split_valid(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows without ``reason``, quarantine rows with ``reason``)."""
    tagged = df.withColumn("reason", reason)
    good = tagged.where(F.col("reason").isNull()).drop("reason")
    bad = tagged.where(F.col("reason").isNotNull())
    return good, bad


def enforce_schema(df: DataFrame, schema: T.StructType, required: Sequence[str]) -> DataFrame:
    """``try_cast`` every field of ``schema`` from its text form; a required field
    that is missing or does not cast makes the record invalid.

    Returns the typed columns plus ``reason`` (NULL when valid)."""
    cols, reasons = [], []
    for f in schema.fields:
        raw = F.col(f.name) if f.name in df.columns else F.lit(None)
        if isinstance(f.dataType, T.BooleanType):
            txt = F.lower(F.trim(raw.cast("string")))
            typed = F.when(txt.isin("true", "1"), F.lit(True)).when(txt.isin("false", "0"), F.lit(False))
        else:
            typed = raw.cast("string").try_cast(f.dataType)
        cols.append(typed.alias(f.name))
        if f.name in required:
            reasons.append((raw.isNull(), f"missing_{f.name}"))
            reasons.append((raw.isNotNull() & typed.isNull(), f"bad_{f.name}"))
    reason = F.lit(None).cast("string")
    for cond, r in reversed(reasons):
        reason = F.when(cond, F.lit(r)).otherwise(reason)
    return df.select(*cols, reason.alias("reason"))
