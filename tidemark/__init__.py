"""tidemark: Spark-native outlier scoring for metric tables and streams.

Every detector is a DataFrame -> DataFrame transform that keeps the input
columns and appends ``is_anomaly boolean, anomaly_score double,
anomaly_type string``.  Fitted state is stored as (small, bounded) tables.
"""

from tidemark.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
