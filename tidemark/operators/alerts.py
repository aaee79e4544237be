"""Alert rules over monitoring metrics, and silent-source (gap) detection.

Rules are a short configured list ``(name, condition, severity)`` where the
condition is a SQL predicate over a metrics table (e.g. ``anomaly_rate > 0.1``).
Each rule is one filter; the alerts are their union, so the metrics table is
never joined against the rules.

A source is *silent* when no reading arrives for ``gap`` (the batch form of a
``service_down`` health rule): the gap to the previous reading of the same
source comes from ``lag`` over the hot-key-safe series window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rolling import over_series
from tidemark.operators.scaling import null_safe_join

# rule set of the original configuration (name, condition, severity)
DEFAULT_RULES = (
    ("high_anomaly_rate", "anomaly_rate > 0.1", "warning"),
    ("service_down", "service_health == 0", "critical"),
)


def evaluate_rules(metrics: DataFrame, rules: Sequence[tuple[str, str, str]] = DEFAULT_RULES,
                   keep: Sequence[str] = ()) -> DataFrame:
    """One alert row per (rule, metrics row) whose condition holds.  A rule whose
    columns the metrics table lacks is an error: skipped, it would never fire."""
    out = None
    for name, cond, sev in rules:
        try:
            metrics.select(F.expr(cond))
        except AnalysisException as e:
            raise ValueError(f"rule {name!r}: the metrics table cannot answer {cond!r}") from e
        a = metrics.where(F.expr(cond)).select(F.lit(name).alias("rule"), F.lit(sev).alias("severity"),
                                               F.lit(cond).alias("condition"), *keep)
        out = a if out is None else out.unionByName(a)
    if out is None:
        return metrics.select(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("severity"),
                              F.lit(None).cast("string").alias("condition"), *keep).limit(0)
    return out


def with_empty_windows(metrics: DataFrame, window: str, duration: str, keys: Sequence[str],
                       zeros: Sequence[str]) -> DataFrame:
    """``metrics`` with a row for every window of every key between the first and the last window of the table;
    in the added rows the columns ``zeros`` are 0 and all others NULL.  A source that sends nothing has no
    metrics row of its own, so a rule about silence can only hold on such a spine.  The windows are
    made per key by ``sequence``; the table of keys is all that is repeated."""
    keys = list(keys)
    ends = metrics.agg(F.min(window).alias("a"), F.max(window).alias("b")).first()
    if ends["a"] is None:
        return metrics
    kind = metrics.schema[window].dataType
    spine = metrics.select(*keys).distinct().withColumn(window, F.explode(F.sequence(
        F.lit(ends["a"]).cast(kind), F.lit(ends["b"]).cast(kind), F.expr(f"INTERVAL {duration}"))))
    return null_safe_join(spine, metrics, [*keys, window], "left").fillna(0, list(zeros))


def silent_sources(df: DataFrame, source: str = "source", ts: str = "timestamp",
                   tie: str | None = "event_id", gap_minutes: float = 60.0, as_of=None, **kw) -> DataFrame:
    """Gaps longer than ``gap_minutes`` between consecutive readings of a source.
    With ``as_of`` (a timestamp) also the open gap from a source's last reading
    until then: a source that has stopped for good has no later reading to show it."""
    order = [ts] + ([tie] if tie else [])

    def cols(w):
        return {"gap_start": F.lag(F.col(ts)).over(w)}

    out = over_series(df.select(source, *order), [source], order, cols, halo_before=1, **kw)
    micros = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("gap_start").cast("timestamp"))
    out = out.withColumn("gap_minutes", micros / 60e6)
    out = out.select(source, "gap_start", F.col(ts).alias("gap_end"), "gap_minutes")
    if as_of is not None:
        end = F.lit(as_of).cast(df.schema[ts].dataType)
        last = df.groupBy(source).agg(F.max(ts).alias("gap_start")).where(F.col("gap_start") < end)
        micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(F.col("gap_start").cast("timestamp"))
        out = out.unionByName(last.select(source, "gap_start", end.alias("gap_end"), (micros / 60e6).alias("gap_minutes")))
    return out.where(F.col("gap_minutes") > gap_minutes)
