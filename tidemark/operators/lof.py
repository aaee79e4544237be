"""Local outlier factor (novelty mode) on one standardised feature.

With one feature the k nearest neighbours of a point lie within k positions
of it in sorted order, so LOF needs no index and no pair explosion:

* training rows get their global position ``_rn`` in ``(x, id)`` order
  (distributed ``positions``: bucket counts + per-bucket row numbers);
* pass 1: of the 2k rows around a row
  the k nearest (ties by position) give the neighbour list and k-distance;
* pass 2: reach distance ``max(d, kdist(o))`` -> ``lrd = 1 / (mean + 1e-10)``;
* pass 3: ``LOF = mean(lrd(o)) / lrd``; offset = exact percentile of ``-LOF``
  at ``100 * contamination``.

The passes run over arrays of a chunk of positions (``chunks``), so a large
training set is split into chunks with a 3k-row halo instead of one task.

Novelty scoring of new values: a new value's insertion rank ``r`` among the
training values is the running count of training rows before it in the
union order; its candidate neighbours are training positions ``r-k+1 .. r+k``,
all inside ONE block of the model's block table (blocks of consecutive
positions with a k-row halo), so each new row joins exactly one block row --
no candidate explosion, no join back to the input.  ``decision = -LOF - offset``;
anomaly iff ``decision < 0``; ``anomaly_score = clamp(-decision, 0, 1)`` and
``reference_score = 1 - decision``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.base import Detector, Model, SeriesSpec, READINGS, with_detection, UnfittedModel, out_names
from tidemark.operators.quantile import exact_percentile
from tidemark.operators.rolling import RN, positions, chunks
from tidemark.session import materialize

EPS = 1e-10
BROADCAST_TRAIN_ROWS = 2_000_000
TRAIN = "rn long, x double, kd double, lrd double, lof double, _id long"
#: rows whose neighbours are looked for at once inside a task
BLOCK_ROWS = 20_000


def _total(parts: np.ndarray) -> np.ndarray:
    """Sums of rows, from the first column to the last."""
    out = np.zeros(len(parts))
    for j in range(parts.shape[1]):
        out += parts[:, j]
    return out


def _factors(x: np.ndarray, k: int, sd: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(k-distance, density, LOF) of each of more than k ordered values."""
    n = len(x)
    around = np.arange(n)[:, None] + np.delete(np.arange(-k, k + 1), k)
    outside = (around < 0) | (around >= n)
    around = np.clip(around, 0, n - 1)
    far = np.abs(x[around] - x[:, None])
    far[outside] = np.inf
    near = np.argsort(far, axis=1, kind="stable")[:, :k]  # by (raw distance, position)
    nb, d = np.take_along_axis(around, near, axis=1), np.take_along_axis(far, near, axis=1) / sd
    kd = d[:, -1]
    lrd = 1.0 / (_total(np.maximum(d, kd[nb])) / k + EPS)
    return kd, lrd, _total(lrd[nb]) / k / lrd


def _chunk_factors(k: int, sd: float):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("rn").to_numpy())
        rn, x, ids, shift = (table.column(c).take(pa.array(order)) for c in ("rn", "x", "_id", "shift"))
        values, found = x.to_numpy(), []
        for first in range(0, len(values), BLOCK_ROWS):
            last = min(first + BLOCK_ROWS, len(values))
            start = max(0, first - 3 * k)
            part = _factors(values[start:last + 3 * k], k, sd)
            found.append([f[first - start:last - start] for f in part])
        kd, lrd, lof = (pa.array(np.concatenate(f)) for f in zip(*found))
        out = pa.table([rn, x, kd, lrd, lof, ids], names=["rn", "x", "kd", "lrd", "lof", "_id"])
        return out.filter(pa.array(shift.to_numpy() == 0))
    return run


class LOFModel(Model):
    kind = "local_outlier_factor"

    def __init__(self, spec, mean, sd, k, n, offset, train: DataFrame, chunk_rows, block: int | None = None):
        self.spec, self.mean, self.sd, self.k, self.n = spec, mean, sd, k, n
        self.offset, self.train, self.chunk_rows = offset, train, chunk_rows
        self.block = block or max(256, 8 * k)
        self._blocks = None

    def _x(self, df):
        return F.col(self.spec.value).cast("double")

    def blocks(self) -> DataFrame:
        """Training rows grouped into blocks of ``block`` consecutive positions
        plus the ``k``-row halo on each side: one bounded array per block
        (``block + 2k + 2`` entries at most), about (1 + 2k/block) x the
        training table in all.  Built once per model and written."""
        if self._blocks is None:
            k, B = self.k, self.block
            rn = F.col("rn")
            lo = F.greatest(F.floor((rn - k - 1) / B), F.lit(0))
            hi = F.floor((rn + k) / B)
            ex = self.train.select("rn", "x", "kd", "lrd", F.explode(F.sequence(lo, hi)).alias("_blk"))
            # sorted by position (rn is the first field): candidates are a slice
            blk = ex.groupBy("_blk").agg(F.sort_array(F.collect_list(F.struct("rn", "x", "kd", "lrd"))).alias("_cand"),
                                         F.min("rn").alias("_bfirst"))
            self._blocks = materialize(blk, "lof-blocks")
        return self._blocks

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        k, B = self.k, self.block
        cols = df.columns
        # insertion rank r of a new value = training rows ordered before it
        # (ties: training first) = running count of training rows in the union;
        # new rows carry all their columns through, so nothing is joined back
        new = df.withColumns({"_x": self._x(df), "_f": F.lit(1), "_oid": F.monotonically_increasing_id()})
        tr = self.train.select(F.col("x").alias("_x"), F.lit(0).alias("_f"), F.col("rn").alias("_oid"))
        both = new.unionByName(tr, allowMissingColumns=True).withColumn("_t", (F.col("_f") == 0).cast("int"))
        r = positions(both, [], ["_x", "_f", "_oid"], weight="_t").where("_f = 1").withColumnRenamed(RN, "_r")
        # one block per new row: block b covers ranks b*B+1 .. (b+1)*B
        r = r.withColumn("_blk", F.floor(F.greatest(F.col("_r") - 1, F.lit(0)) / B))
        blk = self.blocks()
        j = r.join(F.broadcast(blk) if self.n <= BROADCAST_TRAIN_ROWS else blk, "_blk", "left")
        lo = F.greatest(F.col("_r") - (k - 1), F.lit(1))
        hi = F.least(F.col("_r") + k, F.lit(self.n))
        cand = F.slice("_cand", (lo - F.col("_bfirst") + 1).cast("int"), (hi - lo + 1).cast("int"))
        sd = F.lit(self.sd or 1.0)
        near = F.slice(F.sort_array(F.transform(cand, lambda e: F.struct(
            F.abs(e["x"] - F.col("_x")).alias("dr"), e["rn"].alias("rn"), e["kd"].alias("kd"),
            e["lrd"].alias("lrd")))), 1, k)
        j = j.withColumn("_nb", near)
        reach = F.aggregate(F.transform("_nb", lambda e: F.greatest(e["dr"] / sd, e["kd"])), F.lit(0.0),
                            lambda a, b: a + b) / F.size("_nb")
        lrd_new = 1.0 / (reach + F.lit(EPS))
        mean_lrd = F.aggregate(F.transform("_nb", lambda e: e["lrd"]), F.lit(0.0), lambda a, b: a + b) / F.size("_nb")
        out = j.withColumn("_lof", mean_lrd / lrd_new)
        decision = -F.col("_lof") - F.lit(self.offset)
        out = with_detection(out, F.coalesce(decision < 0, F.lit(False)),
                             F.coalesce(F.least(F.greatest(-decision, F.lit(0.0)), F.lit(1.0)), F.lit(0.0)),
                             self.kind, prefix)
        out = out.withColumn(f"{prefix}reference_score", 1.0 - decision)
        return out.select(*cols, *out_names(prefix), f"{prefix}reference_score")


class LOFDetector(Detector):
    name = "lof"

    def __init__(self, spec: SeriesSpec = READINGS, contamination: float = 0.1, n_neighbors: int = 20,
                 chunk_rows: int | None = None, **_):
        super().__init__(spec)
        self.contamination, self.k, self.chunk_rows = float(contamination), int(n_neighbors), chunk_rows

    def fit(self, df: DataFrame) -> LOFModel:
        spec = self.spec
        if spec.id is None:
            raise ValueError("LOF needs a row id column (SeriesSpec.id)")
        # x stays in raw units (ordering and neighbour ranking); distances are
        # divided by the population std, i.e. measured on the standardised value
        x = df.select(F.col(spec.id).cast("bigint").alias("_id"), F.col(spec.value).cast("double").alias("x"))
        x = x.where(F.col("x").isNotNull() & ~F.isnan("x"))
        st = x.agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).first()
        n, mean, sd = int(st["n"]), float(st["m"] or 0.0), float(st["s"] or 0.0)
        if n < 2:
            raise ValueError("LOF needs at least two training rows")
        k = min(self.k, n - 1)
        # enough chunks to use the cluster, each far larger than the 3k halo
        chunk = self.chunk_rows or min(1_000_000, max(-(-n // df.sparkSession.sparkContext.defaultParallelism),
                                                      50 * k, 1000))
        pos = positions(x, [], ["x", "_id"], chunk_rows=chunk, n=n).withColumnRenamed(RN, "rn") \
            .withColumn(RN, F.col("rn"))

        # a row's LOF needs raw rows up to 3k positions away, so the halo is 3k on each side
        dealt = chunks(pos, 3 * k, 3 * k, chunk).select("_chunk", F.col("_shift").alias("shift"), F.col("rn").cast("long").alias("rn"), "x", "_id")
        train = materialize(dealt.groupBy("_chunk").applyInArrow(_chunk_factors(k, sd or 1.0), TRAIN), "lof-train")
        neg = train.select((-F.col("lof")).alias("neg_lof"))
        offset = exact_percentile(neg, "neg_lof", self.contamination).first()[0]
        return LOFModel(spec, mean, sd, k, n, float(offset), train, chunk)

    def unfitted(self):
        return UnfittedModel("unknown")
