"""Table readers and role mappings for the parquet inputs.

Readers select only the columns a role needs so that Catalyst prunes the
parquet scan (``ReadSchema``) and pushes filters into it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def readings(spark: SparkSession, sf_dir: str, source: str = "event_type") -> DataFrame:
    """``events`` as metric readings.

    ``source`` is ``event_type`` (metric = ``user_<id>``) or ``user``
    (source = ``user_<id>``, metric = event_type).  ``timestamp`` keeps the
    parquet ``timestamp_ntz`` type; ``event_id`` breaks ties.
    """
    ev = table(spark, sf_dir, "events")
    user = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    if source == "event_type":
        src, met = F.col("event_type"), user
    else:
        src, met = user, F.col("event_type")
    return ev.select("event_id", F.col("ts").alias("timestamp"), src.alias("source"),
                     met.alias("metric"), "value", "user_id")


def lineitem_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large series: key ``l_suppkey``, total order (shipdate, orderkey, linenumber, partkey)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
                     "l_extendedprice")


def orders_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medium series: key ``o_custkey``, order (orderdate, orderkey)."""
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` joined to ``documents``: value = n_chars, label = toxic.

    ``labels`` is the smaller side, but both grow with the data, so the join is
    left to the planner (AQE turns it into a broadcast when it is small).
    """
    lab = table(spark, sf_dir, "labels").select("doc_id", "toxic", "quality")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source", "lang")
    return (lab.join(doc, "doc_id", "inner")
            .select("doc_id", F.col("n_chars").cast("double").alias("value"),
                    (F.col("toxic") == 1).alias("is_anomaly"), "source", "lang"))
