"""Count-bounded windows over ordered series, safe for hot keys.

A plain ``Window.partitionBy(key)`` puts every row of one key into one task.
That is fine while keys are small, but a key that holds a third of the data
would serialise the whole job.  ``over_series`` therefore runs in two parts:

* **cold keys** (at most ``hot_key_rows`` rows): a plain partitioned window;
* **hot keys**: rows get an exact position inside their key without a
  per-key sort (``positions``: range partitions of the whole order tuple,
  sorted and numbered inside each range, offsets from a small
  ``(range, key)`` count table).  Rows are then dealt into chunks of ``chunk_rows``
  positions; each chunk also receives ``halo_before`` rows of the previous
  chunk and ``halo_after`` rows of the next one, so every frame that stays
  within the halo sees exactly the rows it would see in one big partition.

The caller supplies ``columns(w)`` which builds the new columns from the
ordered window ``w`` (frames via ``w.rowsBetween``).  ``_rn`` (1-based
position inside the key) is always available to ``columns``.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

RN = "_rn"
DEFAULT_HOT_KEY_ROWS = 4_000_000
DEFAULT_CHUNK_ROWS = 1_000_000
# hot key table is broadcast below this many keys, shuffled above it
BROADCAST_KEY_LIMIT = 200_000


def _ordered_window(keys: Sequence[str], order: Sequence) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)


def over_series(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                columns: Callable[[Window], dict[str, Column]],
                halo_before: int, halo_after: int = 0, *,
                hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS,
                chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Add ``columns(w)`` computed over the series ``keys`` ordered by ``order``.

    ``order`` must be a total order inside each key.  Frames used by
    ``columns`` must stay within ``[-halo_before, +halo_after]`` rows.
    ``hot_key_rows=None`` disables the hot-key path (one task per key).
    """
    keys, order = list(keys), list(order)
    if hot_key_rows is None:
        return _plain(df, keys, order, columns)
    chunk_rows = max(chunk_rows, halo_before + halo_after + 1)
    n = df.count()  # reads no column of a plain table
    if n <= hot_key_rows:
        return _plain(df, keys, order, columns)  # no key can be hot, one global series fits a task
    if not keys:
        pos = positions(df, [], order, n=n)
        return chunk_windows(pos, [], columns, halo_before, halo_after, chunk_rows)

    sizes = key_counts(df, keys).where(F.col("_n") > hot_key_rows)
    # one small action: the number of hot keys is at most rows / hot_key_rows
    agg = sizes.agg(F.count(F.lit(1)).alias("k"), F.sum("_n").alias("rows")).first()
    n_hot = agg["k"]
    if n_hot == 0:
        return _plain(df, keys, order, columns)
    sizes = sizes.select(*keys, F.lit(True).alias("_hot"))
    from tidemark.operators.scaling import null_safe_join
    # null-safe: a NULL key that is hot is still split
    tagged = null_safe_join(df, sizes, keys, "left", broadcast=n_hot <= BROADCAST_KEY_LIMIT)
    cold = _plain(tagged.where(F.col("_hot").isNull()).drop("_hot"), keys, order, columns)
    hot = _chunked(tagged.where(F.col("_hot")), keys, order, columns, halo_before, halo_after,
                   chunk_rows, n=agg["rows"])
    return cold.unionByName(hot)


def _plain(df: DataFrame, keys, order, columns) -> DataFrame:
    w = _ordered_window(keys, order)
    df = df.withColumn(RN, F.row_number().over(w))
    return df.withColumns(columns(w))


def key_counts(df: DataFrame, keys) -> DataFrame:
    """Rows per key (hot-key detection; map-side combined)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def positions(df: DataFrame, keys, order, part_rows: int = 2_000_000, weight: str | None = None,
              n: int | None = None, max_parts: int = 50_000, single_task_rows: int = 1_000_000,
              **_) -> DataFrame:
    """1-based position ``_rn`` of every row inside its key (``keys`` may be
    empty: a global position), balanced whatever the skew.

    ``repartitionByRange`` over the whole ``(keys, order)`` tuple cuts the
    total order into contiguous ranges of about ``part_rows`` rows -- Spark
    samples the bounds on the full tuple, so a hot key, a burst in time and a
    duplicated order value are all split.  Rows are sorted inside their range,
    stamped with the range id and a monotonic id and written once (the ids are
    then fixed even if a task is re-run).  A small table of ``(range, key)``
    counts (at most ranges + keys rows) gives each key's offset per range.

    With ``weight`` (a 0/1 column) ``_rn`` is the running count of weighted
    rows up to and including the row (an as-of rank) instead.

    The number of ranges is capped at ``max_parts`` (a shuffle with more
    reducers costs more in block metadata than it saves); beyond that the
    ranges grow (each is one external, spillable sort).  A keyless series of at
    most ``single_task_rows`` rows is numbered by one ordered window instead
    (one bounded task; no write).
    """
    keys, order = list(keys), list(order)
    spark = df.sparkSession
    if n is None:
        n = df.count()
    if not keys and n <= single_task_rows:
        w = Window.orderBy(*order)
        if weight:
            rn = F.sum(F.col(weight).cast("bigint")).over(w.rowsBetween(Window.unboundedPreceding, 0))
        else:
            rn = F.row_number().over(w)
        return df.withColumn(RN, rn)
    parts = min(max(spark.sparkContext.defaultParallelism, -(-n // part_rows), 1), max_parts)
    r = df.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
    r = r.withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()})
    r = materialize(r, "positions")
    g = r.groupBy("_pid", *keys)
    if weight:
        cnt = g.agg(F.sum(F.col(weight).cast("bigint")).alias("_c"))
    else:
        cnt = g.agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    # (range, key) pairs: at most ranges + keys - 1 rows; keyless: one row per range
    wk = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    cnt = cnt.withColumn("_off", F.coalesce(F.sum("_c").over(wk), F.lit(0)))
    from tidemark.operators.scaling import join_params
    out = join_params(r, cnt.drop("_c"), ["_pid", *keys])
    if weight:
        wrow = Window.partitionBy("_pid", *keys).orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn(RN, F.col("_off") + F.sum(F.col(weight).cast("bigint")).over(wrow))
    else:
        out = out.withColumn(RN, F.col("_off") + F.col("_mid") - F.col("_m0") + 1)
    return out.drop("_pid", "_mid", "_m0", "_off")


def _chunked(df: DataFrame, keys, order, columns, halo_before, halo_after,
             chunk_rows, n: int | None = None) -> DataFrame:
    df = positions(df.drop("_hot"), keys, order, n=n)
    return chunk_windows(df, keys, columns, halo_before, halo_after, chunk_rows)


def chunk_windows(df: DataFrame, keys, columns, halo_before: int, halo_after: int = 0,
                  chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Windows over a series that already carries its position ``_rn``.

    Rows are dealt into chunks of ``chunk_rows`` positions; border rows are
    copied into the neighbour chunks (``halo_before`` / ``halo_after``), the
    window runs per ``(keys, chunk)`` ordered by ``_rn``, copies are dropped.

    ``columns`` may be a list of builders applied one after the other (each may
    read the previous ones' columns at neighbour rows).  The halo must then
    cover the sum of the passes' reaches; all passes share one exchange and
    one sort.
    """
    keys = list(keys)
    passes = columns if isinstance(columns, (list, tuple)) else [columns]
    w = Window.partitionBy(*(keys + ["_chunk"])).orderBy(RN)
    out = chunks(df, halo_before, halo_after, chunk_rows)
    for build in passes:
        out = out.withColumns(build(w))
    return out.where(F.col("_shift") == 0).drop("_shift", "_chunk")


def chunks(df: DataFrame, halo_before: int, halo_after: int = 0, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Rows with a position ``_rn`` dealt into ``_chunk``; the copies of border rows in neighbour chunks have a ``_shift`` other than 0."""
    chunk_rows = max(chunk_rows, halo_before + halo_after + 1)
    idx = (F.col(RN) - 1) % chunk_rows
    shifts = F.array(F.lit(0))
    if halo_before:
        shifts = F.when(idx >= chunk_rows - halo_before, F.array_append(shifts, F.lit(1))).otherwise(shifts)
    if halo_after:
        shifts = F.when(idx < halo_after, F.array_append(shifts, F.lit(-1))).otherwise(shifts)
    df = df.withColumn("_shift", F.explode(shifts))
    return df.withColumn("_chunk", F.floor((F.col(RN) - 1) / chunk_rows).cast("bigint") + F.col("_shift"))
