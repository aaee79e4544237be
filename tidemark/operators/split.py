"""Train / test splits.

* ``hash_split``: repeatable split on md5 of the row id (no shuffle, no
  global sort; the same rows land in the same side on every run).
* ``time_series_folds``: expanding-window folds in time order, the
  ``TimeSeriesSplit`` rule: with ``n`` rows and ``k`` folds, ``t = n // (k+1)``;
  fold ``i`` (0-based) tests rows ``[n-(k-i)t, n-(k-i-1)t)`` and trains on all
  rows before them.  The time-order position comes from the distributed
  ``positions`` operator, never from an unpartitioned window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import md5_unit
from tidemark.operators.rolling import RN, positions


def hash_split(df: DataFrame, id_col: str, train_fraction: float = 0.7, seed: str = "") -> DataFrame:
    """Adds ``is_train`` (md5 of the id, optionally salted, below the fraction)."""
    u = md5_unit(id_col) if not seed else md5_unit(id_col, F.lit(seed))
    return df.withColumn("is_train", u < F.lit(train_fraction))


def with_positions(df: DataFrame, order: Sequence[str], chunk_rows: int = 1_000_000) -> DataFrame:
    """Adds ``_pos`` (0-based) in the global order."""
    return positions(df, [], order, chunk_rows=chunk_rows).withColumn("_pos", F.col(RN) - 1).drop(RN)


def fold_bounds(n: int, k: int) -> list[tuple[int, int, int]]:
    """(fold, test_start, test_end) in 0-based positions."""
    t = n // (k + 1)
    return [(i, n - (k - i) * t, n - (k - i - 1) * t) for i in range(k)]


def fold_assignment(df: DataFrame, order: Sequence[str], k: int = 5) -> tuple[DataFrame, int]:
    """Compact folds: adds ``_pos``, ``test_fold`` (the fold whose test block
    holds the row, NULL for rows before the first block) and
    ``train_from_fold`` (first fold whose training set holds the row; it is
    in the training set of every later fold too).  One row per input row."""
    pos = with_positions(df, order)
    n = pos.count()
    bounds = fold_bounds(n, k)
    t = (bounds[0][2] - bounds[0][1]) if bounds else 0
    if t <= 0:
        return pos.withColumns({"test_fold": F.lit(None).cast("int"), "train_from_fold": F.lit(None).cast("int")}), n
    first = bounds[0][1]
    p = F.col("_pos")
    test_fold = F.when(p >= first, F.floor((p - first) / t)).cast("int")
    train_from = F.when(p < first, F.lit(0)).otherwise(test_fold + 1)
    return pos.withColumns({"test_fold": test_fold,
                            "train_from_fold": F.when(train_from <= k - 1, train_from).cast("int")}), n


def fold_summary(df: DataFrame, order: Sequence[str], id_col: str, k: int = 5) -> DataFrame:
    """Per (fold, role): rows and first / last id, from the compact assignment:
    one aggregate per role over a (k+1)-row table, no k-fold row explosion."""
    a, _ = fold_assignment(df, order, k)
    test = (a.where(F.col("test_fold").isNotNull()).groupBy(F.col("test_fold").alias("fold"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(id_col).alias("first_id"),
                 F.max(id_col).alias("last_id")).withColumn("role", F.lit("test")))
    by_start = (a.where(F.col("train_from_fold").isNotNull()).groupBy("train_from_fold")
                .agg(F.count(F.lit(1)).alias("_n"), F.min(id_col).alias("_lo"), F.max(id_col).alias("_hi")))
    # training set of fold f = rows whose train_from_fold <= f: running totals over <= k rows
    w = Window.orderBy("train_from_fold").rowsBetween(Window.unboundedPreceding, 0)
    train = by_start.select(F.col("train_from_fold").alias("fold"), F.sum("_n").over(w).alias("n_rows"),
                            F.min("_lo").over(w).alias("first_id"), F.max("_hi").over(w).alias("last_id"),
                            F.lit("train").alias("role"))
    return test.unionByName(train).select("fold", "role", F.col("n_rows").cast("bigint").alias("n_rows"),
                                          "first_id", "last_id")


def time_series_folds(df: DataFrame, order: Sequence[str], k: int = 5) -> DataFrame:
    """Long format: every (fold, row) pair used by a fold with ``role`` train /
    test.  Output has up to ``k`` copies of a row (about k/2 x the input); use
    ``fold_assignment`` / ``fold_summary`` where the compact form suffices."""
    pos = with_positions(df, order)
    n = pos.count()
    bounds = fold_bounds(n, k)
    if not bounds or bounds[0][1] >= bounds[0][2]:
        return pos.withColumn("fold", F.lit(None).cast("int")).withColumn("role", F.lit(None).cast("string")).limit(0)
    p = F.col("_pos")
    # for each row, the folds in which it is a test row (one) or a train row (those after it)
    t = bounds[0][2] - bounds[0][1]
    first = bounds[0][1]
    test_fold = F.when(p >= first, F.floor((p - first) / t)).cast("int")
    # a row at p trains every fold whose test starts after p
    first_train_fold = F.when(p < first, F.lit(0)).otherwise(test_fold + 1)
    folds = F.sequence(first_train_fold, F.lit(k - 1))
    entries = F.concat(
        F.when(test_fold.isNotNull(), F.array(F.struct(test_fold.alias("fold"), F.lit("test").alias("role"))))
        .otherwise(F.array().cast("array<struct<fold:int,role:string>>")),
        F.when(first_train_fold <= k - 1,
               F.transform(folds, lambda f: F.struct(f.cast("int").alias("fold"), F.lit("train").alias("role"))))
        .otherwise(F.array().cast("array<struct<fold:int,role:string>>")))
    out = pos.withColumn("_e", F.explode(entries))
    return out.select(*pos.columns, "_e.fold", "_e.role")
