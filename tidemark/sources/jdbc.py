"""JDBC source and sink (e.g. a relational metadata / results store).

Reads are split into parallel range queries on a numeric / date column
(``partitionColumn`` with bounds and ``numPartitions``) so one task never
pulls a whole table; predicates and column selection are pushed into the
database query by Spark's JDBC source.  Writes go through ``foreachBatch`` for
streams.  A JDBC driver jar for the target database must be on the class path
(none ships with this package).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower_bound=None, upper_bound=None,
                 num_partitions: int | None = None, fetch_size: int = 10_000, driver: str | None = None) -> dict:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    return opts


def read_jdbc(spark: SparkSession, **kw) -> DataFrame:
    r = spark.read.format("jdbc")
    for k, v in jdbc_options(**kw).items():
        r = r.option(k, v)
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 10_000,
               num_partitions: int | None = None, **kw) -> None:
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size), **{k: str(v) for k, v in kw.items()}}
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    w = df.write.format("jdbc").mode(mode)
    for k, v in opts.items():
        w = w.option(k, v)
    w.save()


def stream_to_jdbc(stream: DataFrame, url: str, table: str, checkpoint: str, **kw):
    """Append each micro-batch to a table (at-least-once; make the table keyed
    to deduplicate retried batches)."""
    def write(batch: DataFrame, epoch: int):
        write_jdbc(batch, url, table, **kw)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
