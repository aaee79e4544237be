"""Distribution drift between a baseline and a current period (PSI).

Bins are ``bins`` equal-width buckets over the baseline's range per key
(values outside fall into the end bins); the population stability index is
``sum((p_cur - p_base) * ln(p_cur / p_base))`` with empty bins floored at
``eps``.  Besides PSI the output compares mean and population std.  All of it
is two small aggregates (per key, per key and bin) and one join of bounded
tables.  NULL and NaN values are no readings: they are left out and counted in
``base_nulls`` and ``cur_nulls``.  A key that is new or has vanished (or holds no
reading) comes out with ``base_n`` or ``cur_n`` 0 and ``drift`` true.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import safe_div
from tidemark.operators.scaling import join_params, null_safe_join
from tidemark.operators.statistical import clean


def psi(baseline: DataFrame, current: DataFrame, value: str = "value", keys: Sequence[str] = (),
        bins: int = 10, eps: float = 1e-6, threshold: float = 0.2) -> DataFrame:
    keys = list(keys)
    baseline = baseline.withColumn(value, clean(baseline, value))
    current = current.withColumn(value, clean(current, value))
    nulls = F.count_if(F.col(value).isNull())
    gb = baseline.groupBy(*keys) if keys else baseline.groupBy()
    rng = gb.agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"), F.avg(value).alias("base_mean"),
                 F.stddev_pop(value).alias("base_std"), F.count(value).alias("base_n"), nulls.alias("base_nulls"))
    gc = current.groupBy(*keys) if keys else current.groupBy()
    cur_stats = gc.agg(F.avg(value).alias("cur_mean"), F.stddev_pop(value).alias("cur_std"),
                       F.count(value).alias("cur_n"), nulls.alias("cur_nulls"))

    def binned(df: DataFrame) -> DataFrame:
        # one row per key: broadcast only after the size check in join_params
        j = join_params(df.where(F.col(value).isNotNull()), rng.select(*keys, "_mn", "_mx"), keys)
        width = F.col("_mx") - F.col("_mn")
        b = F.when(width > 0, F.floor((F.col(value) - F.col("_mn")) / width * bins)).otherwise(0)
        b = F.least(F.greatest(b, F.lit(0)), F.lit(bins - 1)).cast("int")
        return j.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))

    hb = binned(baseline).select(*keys, "bin", F.col("n").alias("nb"), F.lit(0).cast("bigint").alias("nc"))
    hc = binned(current).select(*keys, "bin", F.lit(0).cast("bigint").alias("nb"), F.col("n").alias("nc"))
    # union + group-by (a NULL key is a group) instead of a full outer join
    h = hb.unionByName(hc).groupBy(*keys, "bin").agg(F.sum("nb").alias("nb"), F.sum("nc").alias("nc"))
    # every key of either side, with 0 rows where it is absent
    counts = ["base_n", "cur_n", "base_nulls", "cur_nulls"]
    moments = ["base_mean", "base_std", "cur_mean", "cur_std", *counts]
    both = rng.drop("_mn", "_mx").unionByName(cur_stats, allowMissingColumns=True)
    gs = both.groupBy(*keys) if keys else both.groupBy()
    stats = gs.agg(*[F.max(c).alias(c) for c in moments]).withColumns(
        {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in counts})
    h = join_params(h, stats.select(*keys, "base_n", "cur_n"), keys)
    pb = F.greatest(safe_div(F.col("nb"), F.col("base_n")), F.lit(eps))
    pc = F.greatest(safe_div(F.col("nc"), F.col("cur_n")), F.lit(eps))
    term = (pc - pb) * F.log(pc / pb)
    g = h.groupBy(*keys) if keys else h.groupBy()
    out = g.agg(F.sum(term).alias("psi"))
    one_sided = (F.col("base_n") == 0) | (F.col("cur_n") == 0)
    if keys:
        out = null_safe_join(stats, out, keys, "left")
        return out.withColumn("drift", one_sided | (F.col("psi") > F.lit(threshold)))
    return join_params(out, stats.select(*counts), []).withColumn(
        "drift", one_sided | (F.col("psi") > F.lit(threshold))).drop(*counts)
