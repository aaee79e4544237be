"""Quantile sketches per key and window, and drift between them.

``window_sketches`` reduces readings to one KLL sketch per key and window in a
single scan; ``merge_sketches`` adds windows up to longer periods without
reading the data again.  ``quantile_drift`` compares each window with a
baseline sketch of its key: the quantiles of the whole baseline (all keys merged)
cut the values into bins, and the population stability index compares both
shares of each bin, key by key.  A sketch holds a few thousand numbers whatever the window holds, so no bin
counts, value ranges or rows are shuffled.

A sketch of at most ``k`` values is exact; beyond that a share is off by about
``1.7 / k ** 0.9`` of the rows (k = 4096: 0.1 %).  NULL and NaN values are no
readings; they are counted in ``nulls``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scaling import join_params
from tidemark.operators.statistical import clean

DEFAULT_K = 4096


def window_sketches(df: DataFrame, keys: Sequence[str] = ("source",), ts: str = "timestamp",
                    duration: str = "1 day", value: str = "value", k: int = DEFAULT_K) -> DataFrame:
    """``keys, window_start, sketch, n, nulls`` (sketch NULL for a window without a value)."""
    v = clean(df, value).cast("double")
    return (df.withColumn("_v", v).groupBy(*keys, F.window(ts, duration)["start"].alias("window_start"))
            .agg(F.kll_sketch_agg_double("_v", F.lit(k)).alias("sketch"), F.count("_v").alias("n"),
                 F.count_if(F.col("_v").isNull()).alias("nulls"))
            .withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch"))))


def merge_sketches(sketches: DataFrame, keys: Sequence[str] = ("source",), k: int = DEFAULT_K) -> DataFrame:
    """One sketch per group of ``keys`` from those of its windows."""
    g = sketches.groupBy(*keys) if keys else sketches.groupBy()
    return (g
            .agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.sum("n").alias("n"), F.sum("nulls").alias("nulls"))
            .withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch"))))


def _shares(sketch: Column, edges: list[float]) -> Column:
    """Shares of the values in the bins that ``edges`` close (each edge belongs to the bin below it)."""
    rank = F.kll_sketch_get_rank_double(sketch, F.array(*[F.lit(float(x)) for x in edges]))
    upto = F.concat(F.array(F.lit(0.0)), rank, F.array(F.lit(1.0)))
    return F.transform(F.sequence(F.lit(1), F.lit(len(edges) + 1)), lambda i: F.get(upto, i) - F.get(upto, i - 1))


def quantile_drift(baseline: DataFrame, current: DataFrame, keys: Sequence[str] = ("source",), bins: int = 10,
                   eps: float = 1e-6, threshold: float = 0.2) -> DataFrame:
    """``current`` (rows of sketches) with ``base_n, base_median, median, psi, drift``.  ``baseline`` holds one sketch
    per key; the driver gets the ``bins - 1`` inner edges.  Where one side holds no value ``psi`` is NULL and ``drift``
    true; a key that the baseline lacks has ``base_n`` 0."""
    whole = merge_sketches(baseline, [])
    inner = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    edges = whole.select(F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", inner))).first()[0]
    base = baseline.select(*keys, F.col("sketch").alias("_base"), F.col("n").alias("base_n"))
    out = join_params(current, base, keys)
    both = F.col("sketch").isNotNull() & F.col("_base").isNotNull()
    shares = {c: F.when(both, _shares(F.col(x), edges)) if edges else F.lit(None).cast("array<double>")
              for c, x in (("_b", "_base"), ("_c", "sketch"))}
    out = out.withColumns(shares)
    terms = F.zip_with("_c", "_b", lambda c, b: (F.greatest(c, F.lit(eps)) - F.greatest(b, F.lit(eps)))
                       * F.log(F.greatest(c, F.lit(eps)) / F.greatest(b, F.lit(eps))))
    psi = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    half = F.lit(0.5)
    return out.withColumns({
        "base_n": F.coalesce("base_n", F.lit(0).cast("bigint")), "psi": psi,
        "base_median": F.when(F.col("_base").isNotNull(), F.kll_sketch_get_quantile_double("_base", half)),
        "median": F.when(F.col("sketch").isNotNull(), F.kll_sketch_get_quantile_double("sketch", half)),
        "drift": F.coalesce(psi > F.lit(threshold), F.lit(True))}).drop("_base", "_b", "_c")
