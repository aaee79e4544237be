"""CSV / JSON file sources and sinks for readings (batch and stream).

Schemas are always given (never inferred): inference reads the data twice
and guesses types per file.  Malformed lines are kept as NULL fields in
PERMISSIVE mode with the raw text in ``_corrupt_record`` so they can be
quarantined instead of silently dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.decode import READING

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


def read_csv(spark: SparkSession, path: str, schema: T.StructType = READING, header: bool = True,
             stream: bool = False, options: dict | None = None) -> DataFrame:
    opts = {"header": str(header).lower(), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
            **(options or {})}
    r = (spark.readStream if stream else spark.read).format("csv").schema(_with_corrupt(schema))
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType = READING, stream: bool = False,
              options: dict | None = None) -> DataFrame:
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    r = (spark.readStream if stream else spark.read).format("json").schema(_with_corrupt(schema))
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)
