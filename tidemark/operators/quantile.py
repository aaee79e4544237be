"""Exact, linearly interpolated percentiles without collecting a group.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which does not survive a key holding a third of 100 TB.
``exact_percentile`` instead narrows a bracket around the wanted ranks:

1. per key: ``n`` and the value range;
2. each round: approximate percentiles (Greenwald-Khanna, mergeable) of the
   values between the ends of the bracket; the ones a little below and above
   the wanted ranks become its new ends, and one exact aggregate counts the
   rows below, at and between them;
3. once every bracket holds at most ``max_candidates`` rows, those values
   are collected per key (bounded), sorted, and interpolated.

Ranks, not widths, are cut, so the shape of the data does not matter (outliers
and infinities included): a round leaves about 5 / ``bins`` of the rows and the copies
of two values.  A bracket whose rows are copies of its two ends is
resolved without collecting any.  The result equals ``percentile`` /
DuckDB ``quantile_cont``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scaling import join_params, null_safe_join
from tidemark.session import materialize


def exact_percentile(df: DataFrame, value: str, q: float, keys: Sequence[str] = (), *,
                     bins: int = 1000, max_candidates: int = 200_000, out: str = "percentile") -> DataFrame:
    """Percentile ``q`` (linear interpolation) per key; NULL and NaN are left out.
    One rule for every size: no shortcut and no limit on rounds."""
    keys = list(keys)
    if not keys:
        # one global group: a constant key keeps every step an ordinary keyed job
        res = exact_percentile(df.withColumn("_g", F.lit(0)), value, q, ["_g"], bins=bins,
                               max_candidates=max_candidates, out=out)
        return res.drop("_g")
    v = F.col(value)
    data = df.select(*keys, v.cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    br = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    h = (F.col("_n") - 1) * F.lit(float(q))
    zero = F.lit(0).cast("bigint")
    # _below: rows below _lo; _at_lo, _mid, _at_hi: rows at the ends and between them (the ends not yet counted)
    br = br.select(*keys, "_n", F.floor(h).cast("bigint").alias("_r"), (h - F.floor(h)).alias("_frac"), "_lo", "_hi",
                   zero.alias("_below"), zero.alias("_at_lo"), F.col("_n").alias("_mid"), zero.alias("_at_hi"))
    br = materialize(br, "pct-bracket")
    while True:
        worst = br.where(F.col("_lo") < F.col("_hi")).agg(F.max("_mid")).first()[0]
        if worst is None or worst <= max_candidates:
            break
        br = materialize(_narrow(data, br, keys, bins, max_candidates), "pct-bracket")
    cand = join_params(data, br.select(*keys, "_lo", "_hi"), keys)
    between = (F.col("_v") > F.col("_lo")) & (F.col("_v") < F.col("_hi"))
    # at most max_candidates values per key between the ends; copies of the ends are counted
    vals = (cand.where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
            .groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(between, F.col("_v")))).alias("_vals"),
                                F.count_if(F.col("_v") == F.col("_lo")).alias("_n_lo")))
    res = null_safe_join(br, vals, keys, "left")

    def at(i):
        mid = F.try_element_at("_vals", (i - F.col("_n_lo") + 1).cast("int"))
        return (F.when(i < F.col("_n_lo"), F.col("_lo"))
                .when(i < F.col("_n_lo") + F.size("_vals"), mid).otherwise(F.col("_hi")))

    i = F.col("_r") - F.col("_below")
    x0, x1 = at(i), at(i + 1)
    val = (F.when((F.col("_frac") == 0) | (x0 == x1), x0)
           .otherwise(x0 + F.col("_frac") * (x1 - x0)))
    return res.select(*keys, val.alias(out))


def _narrow(data: DataFrame, br: DataFrame, keys, bins: int, max_candidates: int) -> DataFrame:
    """Brackets whose middle is still too large get new ends; the others stay."""
    wide = (F.col("_lo") < F.col("_hi")) & (F.col("_mid") > max_candidates)
    todo = br.where(wide)
    j = join_params(data, todo.select(*keys, "_lo", "_hi"), keys)
    middle = j.where((F.col("_v") > F.col("_lo")) & (F.col("_v") < F.col("_hi")))
    marks = middle.groupBy(*keys).agg(F.percentile_approx("_v", F.array(*[F.lit(k / bins) for k in range(bins + 1)]),
                                                          F.lit(10 * bins)).alias("_m"))
    # the wanted rank among the middle rows, as one of the marks
    rank = (F.col("_r") - F.col("_below") - F.col("_at_lo")) / F.greatest(F.col("_mid"), F.lit(1)) * bins
    i = F.least(F.greatest(F.floor(rank), F.lit(0)), F.lit(bins)).cast("int") + 1
    near = null_safe_join(todo, marks, keys, "left").select(
        *keys, "_lo", "_hi", F.element_at("_m", F.greatest(i - 1, F.lit(1))).alias("_a"),
        F.element_at("_m", F.least(i + 3, F.lit(bins + 1))).alias("_b"))
    near = materialize(near, "pct-marks")
    v, a, b = F.col("_v"), F.col("_a"), F.col("_b")
    j = join_params(data, near, keys).where((v >= F.col("_lo")) & (v <= F.col("_hi")))
    n = j.groupBy(*keys).agg(
        F.max("_a").alias("_a"), F.max("_b").alias("_b"),
        F.count_if(v == F.col("_lo")).alias("_n_lo"), F.count_if(v == F.col("_hi")).alias("_n_hi"),
        F.count_if(v < a).alias("_lt_a"), F.count_if(v == a).alias("_eq_a"),
        F.count_if(v < b).alias("_lt_b"), F.count_if(v == b).alias("_eq_b"), F.count(F.lit(1)).alias("_all"))
    n = null_safe_join(br, n, keys, "left")
    r = F.col("_r") - F.col("_below")  # the wanted ranks are r and r + 1 of the bracket's rows
    # each end: the nearest of lo, a, b, hi that holds the rank or lies outside of it
    a_ok, b_lo = F.col("_lt_a") <= r, F.col("_lt_b") <= r
    lo = F.when(b_lo, F.struct(b.alias("v"), F.col("_lt_b").alias("lt"), F.col("_eq_b").alias("eq"))) \
        .when(a_ok, F.struct(a.alias("v"), F.col("_lt_a").alias("lt"), F.col("_eq_a").alias("eq"))) \
        .otherwise(F.struct(F.col("_lo").alias("v"), F.lit(0).cast("bigint").alias("lt"), F.col("_n_lo").alias("eq")))
    a_hi, b_ok = F.col("_lt_a") + F.col("_eq_a") > r + 1, F.col("_lt_b") + F.col("_eq_b") > r + 1
    hi = F.when(a_hi, F.struct(a.alias("v"), F.col("_lt_a").alias("lt"), F.col("_eq_a").alias("eq"))) \
        .when(b_ok, F.struct(b.alias("v"), F.col("_lt_b").alias("lt"), F.col("_eq_b").alias("eq"))) \
        .otherwise(F.struct(F.col("_hi").alias("v"), (F.col("_all") - F.col("_n_hi")).alias("lt"), F.col("_n_hi").alias("eq")))
    n = n.withColumn("_x", F.when(a.isNotNull(), lo)).withColumn("_y", F.when(a.isNotNull(), hi))
    x, y = F.col("_x"), F.col("_y")

    def new(column, name):
        return F.coalesce(column, F.col(name)).alias(name)

    mid = F.greatest(y["lt"] - x["lt"] - x["eq"], F.lit(0).cast("bigint"))
    return n.select(*keys, "_n", "_r", "_frac", new(x["v"], "_lo"), new(y["v"], "_hi"), new(F.col("_below") + x["lt"], "_below"),
                    new(x["eq"], "_at_lo"), new(mid, "_mid"), new(y["eq"], "_at_hi"))
