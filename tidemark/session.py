"""Session helpers.

Library code never invents storage locations on a cluster: lineage cuts go
to the shared folder named by ``spark.checkpoint.dir``.  Only the local
builder used by tests and the bench fills that setting in when it is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(cores: int | str = "*", shuffle_partitions: int | None = None,
              app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Local session for tests / bench (UI off, AQE on, UTC)."""
    parts = shuffle_partitions or (8 if cores == "*" else int(cores))
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.python.unix.domain.socket.enabled", "true")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
         .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and stream checkpoints.

    Reads ``spark.checkpoint.dir`` from the session (the cluster's shared
    folder), else the SparkContext's checkpoint directory.  Only a session with
    neither -- a local test session -- gets a private folder, registered with
    ``setCheckpointDir`` (``spark.checkpoint.dir`` cannot change at runtime).
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            # a driver-local folder is not visible to executors on a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder (for stream state,
    model tables written during a job, etc.)."""
    base = checkpoint_dir(spark)
    import uuid
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


_WRITTEN: dict[str, list[str]] = {}


def materialize(df, name: str = "stage"):
    """Cut lineage by writing ``df`` as a parquet table in the shared checkpoint
    folder and reading it back: one job (``Dataset.checkpoint`` computes its
    input twice), and the result survives the loss of any executor.  The path
    is remembered for ``release_scratch``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.parquet(path)


def release_scratch(spark: SparkSession) -> int:
    """Delete the tables ``materialize`` wrote in this application (through the
    Hadoop FileSystem of each path, so HDFS and object stores work too).  Call
    it once results and fitted models built on them are no longer used."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)
    return len(paths)


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state (per-key buffers, window aggregates) in RocksDB on
    local disk with changelog checkpoints instead of the executor heap; set
    before a query starts (it is fixed in the query's checkpoint)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
