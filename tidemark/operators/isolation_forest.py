"""Isolation forest on one (standardised) feature, fitted and applied as Spark jobs.

Fit
1. the value is used as it is: splits at ``min + u * (max - min)`` make the
   trees invariant to shifting and scaling, so standardising first would
   give the same forest;
2. sample ``psi = min(max_samples, n)`` rows per tree without replacement, by
   one rule for every ``n``: the rows are shuffled by ``md5(id, seed, round)``
   and each round deals its first rows in blocks of ``psi`` to ``n // psi`` trees
   (all of them in one round where the rows suffice; a narrow Bernoulli pre-filter
   keeps the shuffled part at a few times ``trees * psi`` rows whatever ``n``);
3. grow all trees level by level with DataFrame rounds over the sample
   (``trees * psi`` rows at most): per node count / min / max, split at
   ``min + u * (max - min)`` with ``u = md5(seed, tree, node)``, left child
   takes ``x <= split``; a node is a leaf when it holds one row, all its values
   are equal, or it is at depth ``ceil(log2 psi)``.  Each round's sample is
   checkpointed to the shared checkpoint folder (lineage cut);
4. a leaf's path length is ``depth + c(size)``; with one feature every tree
   is a step function, so the forest collapses into one sorted interval table
   ``(lo, hi] -> mean path`` (at most ``trees * psi`` rows);
5. score ``s = 2 ** (-mean_path / c(psi))``; threshold = exact percentile of
   the training scores at ``1 - contamination`` (from a histogram over the
   interval table, so it never buffers the training rows), anomaly iff
   ``s > threshold``; ``contamination='auto'`` uses 0.5.

Transform: find the interval with MLlib's ``Bucketizer`` (binary
search in the JVM, narrow) and join the interval scores (bounded, broadcast).
The canonical ``anomaly_score`` is ``s`` in (0, 1]; ``reference_score = 1 + s``
reproduces the ``1 - score_samples`` scale of the original detector.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import md5_unit
from tidemark.operators.base import Detector, Model, SeriesSpec, READINGS, with_detection, UnfittedModel
from tidemark.session import materialize

EULER_GAMMA = 0.5772156649015329


def avg_path_length(n: int) -> float:
    """c(n): mean path length of an unsuccessful search in a binary search tree."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _c_col(n):
    """Column version of ``avg_path_length``."""
    n = n.cast("double")
    return (F.when(n <= 1, F.lit(0.0)).when(n == 2, F.lit(1.0))
            .otherwise(2.0 * (F.log(n - 1.0) + F.lit(EULER_GAMMA)) - 2.0 * (n - 1.0) / n))


class IsolationForestModel(Model):
    kind = "isolation_forest"

    def __init__(self, spec, mean, sd, intervals: DataFrame, splits: list[float], threshold: float,
                 params: dict):
        self.spec, self.mean, self.sd = spec, mean, sd
        self.intervals, self.splits, self.threshold, self.params = intervals, splits, threshold, params

    def _scale(self, df: DataFrame) -> DataFrame:
        sd = self.sd if self.sd else 1.0
        return df.withColumn("_x", (F.col(self.spec.value).cast("double") - F.lit(self.mean)) / F.lit(sd))

    def scores(self, df: DataFrame) -> DataFrame:
        """Input plus ``_s`` (the isolation score) and ``_bin``."""
        x = self._scale(df).withColumn("_nx", -F.col("_x"))
        b = Bucketizer(splits=self.splits, inputCol="_nx", outputCol="_bin", handleInvalid="keep")
        out = b.transform(x).withColumn("_bin", F.col("_bin").cast("int"))
        # interval table: at most trees * psi rows, so broadcasting it is safe
        return out.join(F.broadcast(self.intervals.select("_bin", "_s")), "_bin", "left").drop("_nx")

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        out = self.scores(df)
        s = F.col("_s")
        out = with_detection(out, F.coalesce(s > F.lit(self.threshold), F.lit(False)),
                             F.coalesce(s, F.lit(0.0)), self.kind, prefix)
        out = out.withColumn(f"{prefix}reference_score", F.lit(1.0) + F.coalesce(s, F.lit(0.0)))
        return out.drop("_x", "_bin", "_s")


class IsolationForestDetector(Detector):
    name = "isolation_forest"

    def __init__(self, spec: SeriesSpec = READINGS, contamination=0.1, n_estimators: int = 100,
                 max_samples: int = 256, random_state: int = 42, **_):
        super().__init__(spec)
        self.contamination = contamination
        self.n_estimators, self.max_samples, self.seed = int(n_estimators), int(max_samples), int(random_state)

    # -- sampling ---------------------------------------------------------
    def _sample(self, x: DataFrame, n: int, psi: int) -> DataFrame:
        """Materialized sample ``(tree, _x)`` of ``trees * psi`` rows."""
        T, seed, idc = self.n_estimators, self.seed, self.spec.id
        per_round = min(T, n // psi)  # trees dealt from one shuffle
        rounds = -(-T // per_round)
        k = per_round * psi
        e = x.select(idc, "_x", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("_round"))
        e = e.withColumn("_h", md5_unit(idc, F.lit(str(seed)), F.col("_round")))
        # bounded: about 3k rows a round pass the filter (all n where that is less)
        w = Window.partitionBy("_round").orderBy("_h", idc)
        frac = min(1.0, 3.0 * k / n + 1e-9)
        while True:
            dealt = e.where(F.col("_h") < F.lit(frac)).withColumn("_r", F.row_number().over(w) - 1).where(F.col("_r") < k)
            tree = F.col("_round") * per_round + F.floor(F.col("_r") / psi).cast("int")
            smp = materialize(dealt.select(tree.cast("int").alias("tree"), "_x").where(F.col("tree") < T), "iforest-sample")
            # a draw that came short is done again with a wider filter
            if frac >= 1.0 or smp.count() >= T * psi:
                return smp
            frac = min(1.0, frac * 2.0)

    # -- growth -----------------------------------------------------------
    def _grow(self, sample: DataFrame, psi: int) -> DataFrame:
        """All levels in one job: the sample is hash-partitioned by tree once;
        every level's per-node statistics are a window over ``(tree, node)``,
        which that partitioning already satisfies (no further exchange)."""
        max_depth = int(math.ceil(math.log2(max(psi, 2))))
        parts = max(1, min(self.n_estimators, sample.sparkSession.sparkContext.defaultParallelism))
        cur = sample.repartition(parts, "tree").select(
            "tree", "_x", F.lit(1).cast("bigint").alias("node"), F.lit(float("-inf")).alias("lo"),
            F.lit(float("inf")).alias("hi"), F.lit(None).cast("int").alias("depth"),
            F.lit(None).cast("bigint").alias("cnt"))
        w = Window.partitionBy("tree", "node")
        for depth in range(max_depth + 1):
            cnt, mn, mx = F.count(F.lit(1)).over(w), F.min("_x").over(w), F.max("_x").over(w)
            cur = cur.withColumns({"_cnt": cnt, "_mn": mn, "_mx": mx})
            u = md5_unit(F.lit(f"split{self.seed}"), F.col("tree"), F.col("node"))
            raw = F.col("_mn") + u * (F.col("_mx") - F.col("_mn"))
            split = F.when(raw >= F.col("_mx"), (F.col("_mn") + F.col("_mx")) / 2.0).otherwise(raw)
            active = F.col("depth").isNull()
            can = (F.col("_cnt") > 1) & (F.col("_mn") < F.col("_mx")) & F.lit(depth < max_depth)
            cur = cur.withColumn("_split", F.when(active & can, split))
            right = F.col("_x") > F.col("_split")
            leaf_now = active & F.col("_split").isNull()
            cur = cur.select(
                "tree", "_x",
                F.when(F.col("_split").isNull(), F.col("node"))
                 .otherwise(F.col("node") * 2 + right.cast("bigint")).alias("node"),
                F.when(F.col("_split").isNotNull() & right, F.col("_split")).otherwise(F.col("lo")).alias("lo"),
                F.when(F.col("_split").isNotNull() & ~right, F.col("_split")).otherwise(F.col("hi")).alias("hi"),
                F.when(leaf_now, F.lit(depth)).otherwise(F.col("depth")).alias("depth"),
                F.when(leaf_now, F.col("_cnt")).otherwise(F.col("cnt")).alias("cnt"))
        leaves = cur.groupBy("tree", "node", "lo", "hi", "depth", "cnt").agg(F.count(F.lit(1)).alias("_rows"))
        return materialize(leaves.select("tree", "node", "depth", "lo", "hi", "cnt",
                                         (F.col("depth").cast("double") + _c_col(F.col("cnt"))).alias("path")),
                           "iforest-leaves")

    # -- collapse ---------------------------------------------------------
    def _intervals(self, leaves: DataFrame, psi: int):
        T = self.n_estimators
        ev = (leaves.select(F.col("lo").alias("c"), F.col("path").alias("d"))
              .unionByName(leaves.select(F.col("hi").alias("c"), (-F.col("path")).alias("d")))
              .groupBy("c").agg(F.sum("d").alias("d")))
        # bounded by 2 * trees * psi rows
        w = Window.orderBy("c")
        tab = ev.select("c", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("tot"),
                        F.lead("c").over(w).alias("c_next"))
        tab = tab.where(F.col("c_next").isNotNull())  # drops the +inf end
        cnorm = avg_path_length(psi)
        tab = tab.select(F.col("c").alias("lo"), F.col("c_next").alias("hi"),
                         (F.col("tot") / F.lit(float(T))).alias("mean_path"))
        tab = tab.withColumn("_s", F.pow(F.lit(2.0), -F.col("mean_path") / F.lit(cnorm if cnorm > 0 else 1.0)))
        # bucket of -x: interval j (from the left, 0-based) <-> bucket m - j with
        # m finite boundaries; tab has m + 1 rows (bounded table, one task)
        wj = Window.orderBy("lo")
        tab = tab.withColumn("_j", F.row_number().over(wj) - 1)
        tab = materialize(tab.withColumn("_bin", (F.max("_j").over(Window.partitionBy()) - F.col("_j")).cast("int"))
                          .drop("_j"), "iforest-intervals")
        finite = [r["hi"] for r in tab.select("hi").where(F.col("hi") < float("inf")).orderBy("hi").collect()]
        splits = [float("-inf")] + [-v for v in reversed(finite)] + [float("inf")]
        return tab, splits

    def fit(self, df: DataFrame) -> IsolationForestModel:
        spec = self.spec
        if spec.id is None:
            raise ValueError("isolation forest sampling needs a row id column (SeriesSpec.id)")
        v = F.col(spec.value).cast("double")
        x = df.select(spec.id, v.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
        n = x.count()
        mean, sd = 0.0, 1.0  # identity scaling (see step 1)
        if n == 0:
            raise ValueError("cannot fit an isolation forest on no rows")
        psi = min(self.max_samples, n)
        sample = self._sample(x, n, psi)
        leaves = self._grow(sample, psi)
        intervals, splits = self._intervals(leaves, psi)
        model = IsolationForestModel(spec, mean, sd, intervals, splits, 0.5,
                                     {"n_estimators": self.n_estimators, "max_samples": psi, "seed": self.seed,
                                      "contamination": self.contamination, "n_train": n})
        if self.contamination != "auto":
            scored = model.scores(df.select(spec.value))
            hist = scored.groupBy("_bin").agg(F.count(F.lit(1)).alias("_c"))
            hist = hist.join(F.broadcast(intervals.select("_bin", "_s")), "_bin")
            q = 1.0 - float(self.contamination)
            model.threshold = float(hist.agg(F.percentile("_s", F.lit(q), F.col("_c"))).first()[0])
        return model

    def unfitted(self):
        return UnfittedModel("unknown")
