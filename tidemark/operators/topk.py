"""Recent-anomaly reads (top-k by time).

``recent_anomalies`` is a global top-k: Spark plans it as
``TakeOrderedAndProject`` (per-partition top-k, then a merge of k rows per
partition), so it never sorts the table.  ``recent_per_source`` keeps k rows
per source with ``row_number() <= k``, which Spark turns into a
``WindowGroupLimit`` applied before and after the shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _desc(order: Sequence[str]):
    return [F.col(c).desc() for c in order]


def _retained(results: DataFrame, retention: int | None, order, flag: str) -> DataFrame:
    """Flagged rows, optionally only the last ``retention`` of them overall (the
    serving page keeps a bounded recent list and filters within it)."""
    df = results.where(F.col(flag))
    if retention is not None:
        df = df.orderBy(*_desc(order)).limit(max(retention, 0))
    return df


def recent_anomalies(results: DataFrame, n: int = 100, order: Sequence[str] = ("timestamp", "event_id"),
                     flag: str = "is_anomaly", source: str | None = None, source_col: str = "source",
                     retention: int | None = None) -> DataFrame:
    """Last ``n`` flagged rows (optionally of one source, optionally within the
    last ``retention`` flagged rows overall); ``n <= 0`` gives none."""
    df = _retained(results, retention, order, flag)
    if source is not None:
        df = df.where(F.col(source_col) == source)
    if n <= 0:
        return df.limit(0)
    return df.orderBy(*_desc(order)).limit(n)


def recent_per_source(results: DataFrame, n: int = 50, order: Sequence[str] = ("timestamp", "event_id"),
                      flag: str = "is_anomaly", source_col: str = "source", retention: int | None = None) -> DataFrame:
    """Last ``n`` flagged rows of every source (optionally within the last
    ``retention`` flagged rows overall), with ``recency_rank`` 1 = newest."""
    w = Window.partitionBy(source_col).orderBy(*_desc(order))
    df = _retained(results, retention, order, flag).withColumn("recency_rank", F.row_number().over(w))
    return df.where(F.col("recency_rank") <= n)


def bounded_retention(results: DataFrame, keep: int = 1000, show: int = 10,
                      order: Sequence[str] = ("timestamp", "event_id"), flag: str = "is_anomaly") -> DataFrame:
    """The retained recent list (last ``keep``) and the ``show`` newest of it, newest first."""
    kept = recent_anomalies(results, keep, order, flag)
    return kept.orderBy(*_desc(order)).limit(show)
