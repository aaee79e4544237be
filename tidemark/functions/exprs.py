"""Column-expression helpers (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """NULL instead of an ANSI division error (x/0)."""
    return F.try_divide(col(a), col(b))


def md5_unit(*parts) -> Column:
    """Repeatable uniform number in [0, 1) from md5 of the '|'-joined parts.

    DuckDB twin: ``('0x' || substr(md5(s), 1, 8))::BIGINT / 4294967296.0``.
    """
    s = F.concat_ws("|", *[col(p).cast("string") for p in parts])
    return md5_unit_of(s)


def md5_unit_of(s: Column) -> Column:
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def sorted_quantile(arr, q: float) -> Column:
    """Linearly interpolated q-quantile of an ascending ``array<double>``
    (numpy's ``percentile`` rule, including its lerp form for t >= 0.5)."""
    arr = col(arr)
    n = F.size(arr)
    h = (n - 1).cast("double") * F.lit(float(q))
    lo = F.floor(h).cast("int")
    t = h - lo
    a = F.element_at(arr, lo + 1)
    b = F.element_at(arr, F.least(lo + 2, n))
    return F.when(n > 0, F.when(t >= 0.5, b - (b - a) * (1.0 - t)).otherwise(a + (b - a) * t))
