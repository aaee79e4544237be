"""Named queries over the parquet inputs, each with an equivalent SQL text.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the operator on whole
tables; ``ORACLE[name]`` is the same computation as plain SQL over views named
after the tables, used as an independent check (DuckDB).  Doubles that come
out of floating-point arithmetic are rounded to 6 places on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.base import SeriesSpec
from tidemark.operators import statistical as st
from tidemark.sources import tables as tb


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def dec6(c):
    """Round to 6 places through DECIMAL(38,10): exact ties (means of 2-decimal
    values) and last-bit summation differences round the same way in both engines."""
    return F.round((F.col(c) if isinstance(c, str) else c).cast("decimal(38,10)"), 6).cast("double")


def D6(expr: str) -> str:
    """SQL twin of ``dec6``."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), 6) AS DOUBLE)"


def detection_cols():
    return ["is_anomaly", r6("anomaly_score").alias("anomaly_score"), "anomaly_type"]


# ---------------------------------------------------------------- series specs


EVENTS_BY_TYPE = SeriesSpec(("source",), ("timestamp", "event_id"), "value", "event_id")


EVENTS_BY_USER = SeriesSpec(("source",), ("timestamp", "event_id"), "value", "event_id")


LINEITEM = SeriesSpec(("l_suppkey",), ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"),
                      "l_extendedprice")


ORDERS = SeriesSpec(("o_custkey",), ("o_orderdate", "o_orderkey"), "o_totalprice", "o_orderkey")


GLOBAL_EVENTS = SeriesSpec((), ("timestamp", "event_id"), "value", "event_id")


# ---------------------------------------------------------------- SQL builders (the oracle side)


def _zscore_sql(select_cols: str, src: str, part: str, order: str, value: str,
                window: int = 100, thr: float = 3.0, min_hist: int = 10, digits: int | None = 6) -> str:
    rnd, end = ("round(", ", 6)") if digits else ("(", ")")
    return f"""
WITH s AS (
  SELECT *, row_number() OVER w0 AS rn, avg({value}) OVER w AS m, stddev_pop({value}) OVER w AS sd
  FROM ({src}) q
  WINDOW w0 AS (PARTITION BY {part} ORDER BY {order}),
         w AS (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {window - 1} PRECEDING AND 1 PRECEDING)
)
SELECT {select_cols},
  CASE WHEN rn - 1 < {min_hist} OR sd IS NULL OR sd = 0 THEN false
       ELSE abs(({value} - m) / sd) > {thr} END AS is_anomaly,
  {rnd}CASE WHEN rn - 1 < {min_hist} OR sd IS NULL OR sd = 0 THEN 0.0
       ELSE least(abs(({value} - m) / sd) / {thr}, 1.0) END{end} AS anomaly_score,
  CASE WHEN rn - 1 < {min_hist} THEN 'statistical' ELSE 'zscore' END AS anomaly_type
FROM s"""


def _iqr_sql(select_cols: str, src: str, part: str, order: str, value: str,
             window: int = 100, thr: float = 3.0, min_hist: int = 10, digits: int | None = 6) -> str:
    rnd, end = ("round(", ", 6)") if digits else ("(", ")")
    return f"""
WITH s AS (
  SELECT *, row_number() OVER w0 AS rn,
         quantile_cont({value}, 0.25) OVER w AS q1, quantile_cont({value}, 0.75) OVER w AS q3
  FROM ({src}) q
  WINDOW w0 AS (PARTITION BY {part} ORDER BY {order}),
         w AS (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {window - 1} PRECEDING AND 1 PRECEDING)
), b AS (
  SELECT *, q3 - q1 AS iqr, q1 - {thr} * (q3 - q1) AS lo, q3 + {thr} * (q3 - q1) AS hi FROM s
)
SELECT {select_cols},
  CASE WHEN rn - 1 < {min_hist} THEN false ELSE ({value} < lo OR {value} > hi) END AS is_anomaly,
  {rnd}CASE WHEN rn - 1 < {min_hist} THEN 0.0
             WHEN {value} < lo THEN CASE WHEN iqr = 0 THEN 1.0 ELSE least((lo - {value}) / iqr / {thr}, 1.0) END
             WHEN {value} > hi THEN CASE WHEN iqr = 0 THEN 1.0 ELSE least(({value} - hi) / iqr / {thr}, 1.0) END
             ELSE 0.0 END{end} AS anomaly_score,
  CASE WHEN rn - 1 < {min_hist} THEN 'statistical' ELSE 'iqr' END AS anomaly_type
FROM b"""


def _u(expr: str) -> str:
    """DuckDB twin of ``md5_unit``."""
    return f"(('0x' || substr(md5({expr}), 1, 8))::BIGINT / 4294967296.0)"


def _inject_sql(src: str = "SELECT * FROM events", id_col: str = "event_id", value: str = "value",
                seed: int = 42, rate: float = 0.05) -> str:
    idv = f"CAST({id_col} AS VARCHAR)"
    hit = _u(f"concat_ws('|', {idv}, '{seed}', 'hit')")
    kind = _u(f"concat_ws('|', {idv}, '{seed}', 'kind')")
    mag = _u(f"concat_ws('|', {idv}, '{seed}', 'mag')")
    return f"""
SELECT *, CASE WHEN {hit} < {rate} THEN
         CASE WHEN {kind} < 1.0 / 3.0 THEN 'spike' WHEN {kind} < 2.0 / 3.0 THEN 'drop' ELSE 'drift' END END
         AS anomaly_kind,
       {hit} < {rate} AS is_anomaly,
       CASE WHEN {hit} < {rate} THEN round({value}, 2) END AS normal_value,
       round(CASE WHEN {hit} < {rate} THEN {value} +
         CASE WHEN {kind} < 1.0 / 3.0 THEN 20.0 + 30.0 * {mag}
              WHEN {kind} < 2.0 / 3.0 THEN -(20.0 + 30.0 * {mag})
              ELSE -30.0 + 60.0 * {mag} END
         ELSE {value} END, 2) AS injected_value
FROM ({src}) src"""


def _report_sql(src: str) -> str:
    """Weighted precision / recall / f1 and accuracy of (label, pred) rows."""
    return f"""
SELECT round((p0 * (tn + fp) + p1 * (tp + fn)) / n, 6) AS precision,
       round((r0 * (tn + fp) + r1 * (tp + fn)) / n, 6) AS recall,
       round((coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) * (tn + fp)
            + coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) * (tp + fn)) / n, 6) AS f1_score,
       round((tn + tp) / n, 6) AS accuracy
FROM (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
             coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
             tn + fp + fn + tp AS n
      FROM (SELECT count(*) FILTER (WHERE NOT label AND NOT pred) AS tn,
                   count(*) FILTER (WHERE NOT label AND pred) AS fp,
                   count(*) FILTER (WHERE label AND NOT pred) AS fn,
                   count(*) FILTER (WHERE label AND pred) AS tp FROM ({src}) s) c) m"""


def _iforest_sql(train_sql: str, score_sql: str, trees: int = 100, psi_max: int = 256, seed: int = 42,
                 contamination: float = 0.1, digits: int | None = 6) -> str:
    """Isolation forest grown level by level in SQL with the same md5 randomness."""
    import math
    depth = int(math.ceil(math.log2(psi_max)))
    hr = _u(f"concat_ws('|', CAST(id AS VARCHAR), '{seed}', CAST(round AS VARCHAR))")
    us = _u(f"concat_ws('|', 'split{seed}', CAST(tree AS VARCHAR), CAST(node AS VARCHAR))")
    c = ("CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 "
         "ELSE 2.0 * (ln({n} - 1.0) + 0.5772156649015329) - 2.0 * ({n} - 1.0) / {n} END")
    ctes = [f"tr AS ({train_sql})",
            "nn AS (SELECT count(*) AS n FROM tr)",
            f"m AS (SELECT least({psi_max}, n) AS psi, least({trees}, n // least({psi_max}, n)) AS per_round FROM nn)",
            f"rounds AS (SELECT CAST(unnest(range(CAST(ceil({trees} / per_round) AS BIGINT))) AS INTEGER) AS round FROM m)",
            f"deal AS (SELECT x, round, row_number() OVER (PARTITION BY round ORDER BY h, id) - 1 AS r "
            f"FROM (SELECT id, x, round, {hr} AS h FROM tr, rounds) e)",
            f"s0 AS (SELECT CAST(round * per_round + r // psi AS INTEGER) AS tree, x, CAST(1 AS BIGINT) AS node, "
            f"CAST('-inf' AS DOUBLE) AS lo, CAST('inf' AS DOUBLE) AS hi "
            f"FROM deal, m WHERE r < per_round * psi AND round * per_round + r // psi < {trees})"]
    leaves = []
    for d in range(depth + 1):
        ctes.append(f"st{d} AS (SELECT tree, node, lo, hi, count(*) AS cnt, min(x) AS mn, max(x) AS mx "
                    f"FROM s{d} GROUP BY tree, node, lo, hi)")
        ctes.append(f"sp{d} AS (SELECT *, CASE WHEN cnt > 1 AND mn < mx AND {d} < {depth} THEN "
                    f"CASE WHEN mn + {us} * (mx - mn) >= mx THEN (mn + mx) / 2.0 ELSE mn + {us} * (mx - mn) END "
                    f"END AS split FROM st{d})")
        leaves.append(f"SELECT tree, lo, hi, {d} + {c.format(n='cnt')} AS path FROM sp{d} WHERE split IS NULL")
        if d < depth:
            ctes.append(f"s{d + 1} AS (SELECT s.tree, s.x, s.node * 2 + CASE WHEN s.x > p.split THEN 1 ELSE 0 END AS node, "
                        f"CASE WHEN s.x > p.split THEN p.split ELSE s.lo END AS lo, "
                        f"CASE WHEN s.x > p.split THEN s.hi ELSE p.split END AS hi "
                        f"FROM s{d} s JOIN sp{d} p ON s.tree = p.tree AND s.node = p.node WHERE p.split IS NOT NULL)")
    ctes.append("leaves AS (" + " UNION ALL ".join(leaves) + ")")
    cpsi = c.format(n=f"least({psi_max}, (SELECT n FROM nn))")
    ctes.append(f"trs AS (SELECT t.id, pow(2.0, -avg(l.path ORDER BY l.tree) / ({cpsi})) AS s "
                f"FROM tr t JOIN leaves l ON t.x > l.lo AND t.x <= l.hi GROUP BY t.id)")
    ctes.append(f"thr AS (SELECT quantile_cont(s, {1.0 - contamination}) AS t FROM trs)")
    ctes.append(f"sc AS ({score_sql})")
    ctes.append(f"scs AS (SELECT q.id, pow(2.0, -avg(l.path ORDER BY l.tree) / ({cpsi})) AS s "
                f"FROM sc q JOIN leaves l ON q.x > l.lo AND q.x <= l.hi GROUP BY q.id)")
    score = "round(s, 6)" if digits else "s"
    return ("WITH " + ",\n".join(ctes) +
            f"\nSELECT id AS event_id, s > (SELECT t FROM thr) AS is_anomaly, {score} AS anomaly_score FROM scs")


# ---------------------------------------------------------------- shared inputs: readings as SQL, the z-score result table, injected labels


EVENTS_BY_TYPE_SQL = ("SELECT event_id, ts AS timestamp, event_type AS source, "
                      "'user_' || CAST(user_id AS VARCHAR) AS metric, value FROM events")


EVENTS_BY_USER_SQL = ("SELECT event_id, ts AS timestamp, 'user_' || CAST(user_id AS VARCHAR) AS source, "
                      "event_type AS metric, value FROM events")


# the z-score results over events keyed by event type: the "results table"
# that the monitoring reads (statistics, trend, recent anomalies) run on
ZRES_SQL = _zscore_sql("event_id, timestamp, source, metric, value", EVENTS_BY_TYPE_SQL, "source",
                       "timestamp, event_id", "value", digits=None)


def zscore_results(spark, sf):
    return st.rolling_zscore(tb.readings(spark, sf, "event_type"), EVENTS_BY_TYPE)


INJECTED_SQL = _inject_sql("SELECT event_id, ts AS timestamp, event_type AS source, value FROM events")


def injected_events(spark, sf):
    from tidemark.operators.inject import inject_anomalies
    ev = tb.readings(spark, sf)
    return inject_anomalies(ev, "event_id", "value", seed=42)


def _labelled_events(spark, sf):
    """Events with injected, labelled anomalies (value replaced)."""
    return injected_events(spark, sf).drop("normal_value", "anomaly_kind")


# ---------------------------------------------------------------- E1-E5 rolling detectors


@register("rolling_zscore_events",
          _zscore_sql("event_id, source, value", EVENTS_BY_TYPE_SQL, "source", "timestamp, event_id", "value"))
def rolling_zscore_events(spark, sf):
    df = tb.readings(spark, sf, "event_type")
    out = st.rolling_zscore(df, EVENTS_BY_TYPE)
    return out.select("event_id", "source", "value", *detection_cols())


@register("rolling_zscore_by_user",
          _zscore_sql("event_id, source, value", EVENTS_BY_USER_SQL, "source", "timestamp, event_id", "value",
                      window=30))
def rolling_zscore_by_user(spark, sf):
    df = tb.readings(spark, sf, "user")
    out = st.rolling_zscore(df, EVENTS_BY_USER, window_size=30)
    return out.select("event_id", "source", "value", *detection_cols())


@register("rolling_zscore_lineitem",
          _zscore_sql("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice",
                      "SELECT * FROM lineitem", "l_suppkey",
                      "l_shipdate, l_orderkey, l_linenumber, l_partkey", "l_extendedprice"))
def rolling_zscore_lineitem(spark, sf):
    df = tb.lineitem_series(spark, sf)
    out = st.rolling_zscore(df, LINEITEM)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", *detection_cols())


@register("rolling_iqr_events",
          _iqr_sql("event_id, source, value", EVENTS_BY_TYPE_SQL, "source", "timestamp, event_id", "value"))
def rolling_iqr_events(spark, sf):
    out = st.rolling_iqr(tb.readings(spark, sf, "event_type"), EVENTS_BY_TYPE)
    return out.select("event_id", "source", "value", *detection_cols())


@register("rolling_iqr_orders",
          _iqr_sql("o_orderkey, o_custkey, o_totalprice", "SELECT * FROM orders", "o_custkey",
                   "o_orderdate, o_orderkey", "o_totalprice", window=20, thr=1.5))
def rolling_iqr_orders(spark, sf):
    out = st.rolling_iqr(tb.orders_series(spark, sf), ORDERS, window_size=20, threshold=1.5)
    return out.select("o_orderkey", "o_custkey", "o_totalprice", *detection_cols())


@register("seeded_history_zscore", "SELECT event_id, source, value, is_anomaly, anomaly_score, anomaly_type FROM ("
          + _zscore_sql("event_id, timestamp, source, value", EVENTS_BY_TYPE_SQL, "source", "timestamp, event_id",
                        "value")
          + ") z WHERE timestamp >= (SELECT min(ts) FROM events) + INTERVAL 15 DAY")
def seeded_history_zscore(spark, sf):
    """Buffers preloaded with the first 15 days; the rest is scored."""
    ev = tb.readings(spark, sf)
    start = ev.agg(F.min("timestamp")).first()[0]
    cut = F.lit(start) + F.expr("INTERVAL 15 DAYS")
    model = st.StatisticalDetector(EVENTS_BY_TYPE).fit(ev.where(F.col("timestamp") < cut))
    out = model.transform(ev.where(F.col("timestamp") >= cut))
    return out.select("event_id", "source", "value", *detection_cols())


# ---------------------------------------------------------------- D1-D3, D10-D12, F1-F2, I7, K9 monitoring


def _stats_sql(group: str = "", select: str = "") -> str:
    gb = f"GROUP BY {group}" if group else ""
    return f"""
SELECT {select}count(*) AS processed_count,
       count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
       round(coalesce(count(*) FILTER (WHERE is_anomaly) / nullif(count(*), 0), 0.0), 6) AS anomaly_rate,
       round(coalesce(count(*) FILTER (WHERE is_anomaly) / nullif(count(*), 0), 0.0) * 100.0, 6)
         AS anomaly_rate_pct
FROM ({ZRES_SQL}) r {gb}"""


def _round_rates(df, *cols):
    return df.withColumns({c: r6(c) for c in cols})


@register("flagship_zscore_statistics", _stats_sql("source", "source, "))
def flagship_zscore_statistics(spark, sf):
    from tidemark.operators import aggregates as ag
    out = ag.processing_statistics(zscore_results(spark, sf), ["source"])
    return _round_rates(out, "anomaly_rate", "anomaly_rate_pct")


@register("processing_statistics", _stats_sql())
def processing_statistics_q(spark, sf):
    from tidemark.operators import aggregates as ag
    return _round_rates(ag.processing_statistics(zscore_results(spark, sf)), "anomaly_rate", "anomaly_rate_pct")


@register("anomalies_by_source", _stats_sql("source", "source, "))
def anomalies_by_source_q(spark, sf):
    from tidemark.operators import aggregates as ag
    return _round_rates(ag.anomalies_by_source(zscore_results(spark, sf)), "anomaly_rate", "anomaly_rate_pct")


@register("dashboard_statistics", f"""
SELECT count(*) AS total_processed, count(*) FILTER (WHERE is_anomaly) AS total_anomalies,
       max(timestamp) AS last_update,
       round(coalesce(count(*) FILTER (WHERE is_anomaly) / nullif(count(*), 0), 0.0) * 100.0, 6) AS anomaly_rate
FROM ({ZRES_SQL}) r""")
def dashboard_statistics_q(spark, sf):
    from tidemark.operators import aggregates as ag
    return _round_rates(ag.dashboard_statistics(zscore_results(spark, sf)), "anomaly_rate")


@register("anomaly_trend_daily", f"""
SELECT time_bucket(INTERVAL '1 day', timestamp) AS window_start, source,
       count(*) AS processed_count, count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
       round(count(*) FILTER (WHERE is_anomaly) * 100.0 / count(*), 6) AS anomaly_rate_pct
FROM ({ZRES_SQL}) r GROUP BY 1, 2""")
def anomaly_trend_daily(spark, sf):
    from tidemark.operators import aggregates as ag
    out = ag.anomaly_trend(zscore_results(spark, sf), duration="1 day", keys=["source"])
    return _round_rates(out, "anomaly_rate_pct")


@register("recent_anomalies", f"""
SELECT event_id, timestamp, source, value, round(anomaly_score, 6) AS anomaly_score
FROM ({ZRES_SQL}) r WHERE is_anomaly ORDER BY timestamp DESC, event_id DESC LIMIT 100""")
def recent_anomalies_q(spark, sf):
    from tidemark.operators import topk
    out = topk.recent_anomalies(zscore_results(spark, sf), 100)
    return out.select("event_id", "timestamp", "source", "value", r6("anomaly_score").alias("anomaly_score"))


@register("recent_anomalies_per_source", f"""
SELECT * FROM (
  SELECT event_id, timestamp, source, value, round(anomaly_score, 6) AS anomaly_score,
         row_number() OVER (PARTITION BY source ORDER BY timestamp DESC, event_id DESC) AS recency_rank
  FROM ({ZRES_SQL}) r WHERE is_anomaly) t
WHERE recency_rank <= 5""")
def recent_anomalies_per_source_q(spark, sf):
    from tidemark.operators import topk
    out = topk.recent_per_source(zscore_results(spark, sf), 5)
    return out.select("event_id", "timestamp", "source", "value", r6("anomaly_score").alias("anomaly_score"),
                      F.col("recency_rank").cast("bigint").alias("recency_rank"))


def _wstats_sql(width: str) -> str:
    return f"""
SELECT time_bucket(INTERVAL '{width}', ts) AS window_start,
       time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS window_end,
       event_type AS source, {D6("avg(value)")} AS avg_value, {D6("stddev_samp(value)")} AS std_value,
       count(value) AS count
FROM events GROUP BY 1, 2, 3"""


def _wstats(spark, sf, width):
    from tidemark.operators import aggregates as ag
    out = ag.window_stats(tb.readings(spark, sf, "event_type"), duration=width, keys=["source"])
    return out.withColumns({"avg_value": dec6("avg_value"), "std_value": dec6("std_value")})


for _w, _n in (("1 minute", "1m"), ("1 hour", "1h"), ("1 day", "1d")):
    register(f"window_stats_{_n}", _wstats_sql(_w))(lambda spark, sf, _w=_w: _wstats(spark, sf, _w))


@register("drift_psi", f"""
WITH ev0 AS (SELECT event_type AS source, value, ts < (SELECT min(ts) FROM events) + INTERVAL 15 DAY AS is_base
            FROM events),
ev AS (SELECT CASE WHEN source = (SELECT min(source) FROM ev0) AND NOT is_base THEN source || '_v2' ELSE source END AS source,
              value, is_base FROM ev0),
rng AS (SELECT source, min(value) AS mn, max(value) AS mx, avg(value) AS base_mean,
               stddev_pop(value) AS base_std, count(*) AS base_n FROM ev WHERE is_base GROUP BY 1),
cur AS (SELECT source, avg(value) AS cur_mean, stddev_pop(value) AS cur_std, count(*) AS cur_n
        FROM ev WHERE NOT is_base GROUP BY 1),
b AS (SELECT ev.source, is_base, CAST(least(greatest(CASE WHEN mx - mn > 0 THEN floor((value - mn) / (mx - mn) * 10)
                                                   ELSE 0 END, 0), 9) AS INTEGER) AS bin
      FROM ev LEFT JOIN rng USING (source)),
n AS (SELECT source, base_mean, base_std, cur_mean, cur_std, coalesce(base_n, 0) AS base_n, coalesce(cur_n, 0) AS cur_n
      FROM rng FULL JOIN cur USING (source)),
h AS (SELECT source, bin, count(*) FILTER (WHERE is_base) AS nb, count(*) FILTER (WHERE NOT is_base) AS nc
      FROM b GROUP BY 1, 2),
p AS (SELECT source, greatest(coalesce(nc / nullif(cur_n, 0), 0), 1e-6) AS pc, greatest(coalesce(nb / nullif(base_n, 0), 0), 1e-6) AS pb
      FROM h JOIN n USING (source)),
t AS (SELECT source, (pc - pb) * ln(pc / pb) AS term FROM p)
SELECT source, round(sum(term), 6) AS psi, sum(term) > 0.2 OR any_value(base_n) = 0 OR any_value(cur_n) = 0 AS drift,
       any_value({D6("base_mean")}) AS base_mean, any_value({D6("base_std")}) AS base_std,
       any_value({D6("cur_mean")}) AS cur_mean, any_value({D6("cur_std")}) AS cur_std,
       any_value(base_n) AS base_n, any_value(cur_n) AS cur_n
FROM t JOIN n USING (source) GROUP BY source""")
def drift_psi(spark, sf):
    from tidemark.operators.drift import psi
    ev = tb.readings(spark, sf)
    start = ev.agg(F.min("timestamp")).first()[0]
    cut = F.lit(start) + F.expr("INTERVAL 15 DAYS")
    # one source goes on under another name: a vanished and a new key
    first = ev.agg(F.min("source")).first()[0]
    now = ev.where(F.col("timestamp") >= cut).withColumn(
        "source", F.when(F.col("source") == first, F.concat("source", F.lit("_v2"))).otherwise(F.col("source")))
    out = psi(ev.where(F.col("timestamp") < cut), now, "value", ["source"])
    return out.select("source", r6("psi").alias("psi"), "drift", *[dec6(c).alias(c) for c in
                      ("base_mean", "base_std", "cur_mean", "cur_std")], "base_n", "cur_n")


DRIFT_NULLS_SQL = f"""
WITH ev AS (SELECT source, value, timestamp < (SELECT min(ts) FROM events) + INTERVAL 15 DAY AS is_base FROM ({{BROKEN}}) b),
rng AS (SELECT source, min(value) AS mn, max(value) AS mx, avg(value) AS base_mean, count(value) AS base_n,
               count(*) - count(value) AS base_nulls FROM ev WHERE is_base GROUP BY 1),
cur AS (SELECT source, avg(value) AS cur_mean, count(value) AS cur_n, count(*) - count(value) AS cur_nulls FROM ev WHERE NOT is_base GROUP BY 1),
b AS (SELECT ev.source, is_base, CAST(least(greatest(floor((value - mn) / (mx - mn) * 10), 0), 9) AS INTEGER) AS bin
      FROM ev JOIN rng USING (source) WHERE value IS NOT NULL),
h AS (SELECT source, bin, count(*) FILTER (WHERE is_base) AS nb, count(*) FILTER (WHERE NOT is_base) AS nc FROM b GROUP BY 1, 2),
p AS (SELECT source, greatest(nc / cur_n, 1e-6) AS pc, greatest(nb / base_n, 1e-6) AS pb FROM h JOIN rng USING (source) JOIN cur USING (source))
SELECT source, round(sum((pc - pb) * ln(pc / pb)), 6) AS psi, sum((pc - pb) * ln(pc / pb)) > 0.2 AS drift,
       any_value({D6("base_mean")}) AS base_mean, any_value({D6("cur_mean")}) AS cur_mean, any_value(base_n) AS base_n,
       any_value(cur_n) AS cur_n, any_value(base_nulls) AS base_nulls, any_value(cur_nulls) AS cur_nulls
FROM p JOIN rng USING (source) JOIN cur USING (source) GROUP BY source"""


@register("drift_nulls")
def drift_nulls(spark, sf):
    """Drift over readings some of which are NULL or NaN: they are counted apart and move neither bins nor means."""
    from tidemark.operators.drift import psi
    ev = tb.readings(spark, sf).withColumn("value", _broken_value())
    cut = F.lit(ev.agg(F.min("timestamp")).first()[0]) + F.expr("INTERVAL 15 DAYS")
    out = psi(ev.where(F.col("timestamp") < cut), ev.where(F.col("timestamp") >= cut), "value", ["source"])
    return out.select("source", r6("psi").alias("psi"), "drift", dec6("base_mean").alias("base_mean"),
                      dec6("cur_mean").alias("cur_mean"), "base_n", "cur_n", "base_nulls", "cur_nulls")


@register("drift_quantiles", """
WITH e AS (SELECT event_type AS source, ts, value FROM events),
cut AS (SELECT time_bucket(INTERVAL '1 day', min(ts)) + INTERVAL 10 DAY AS c FROM e),
base AS (SELECT source, value, row_number() OVER (PARTITION BY source ORDER BY value) AS rn, count(*) OVER (PARTITION BY source) AS n
         FROM e, cut WHERE ts < c),
cur AS (SELECT source, time_bucket(INTERVAL '1 day', ts) AS window_start, value FROM e, cut WHERE ts >= c),
ranked AS (SELECT value, row_number() OVER (ORDER BY value) AS rn, count(*) OVER () AS n FROM base),
ed AS (SELECT i, min(value) AS edge FROM ranked, range(1, 10) t(i) WHERE rn * 10 >= i * n GROUP BY 1),
bu AS (SELECT source, i, count(*) FILTER (WHERE value <= edge) / count(*) AS u FROM ed, base GROUP BY 1, 2),
cu AS (SELECT source, window_start, i, count(*) FILTER (WHERE value <= edge) / count(*) AS u FROM ed, cur GROUP BY 1, 2, 3),
j AS (SELECT cu.source, window_start, i, bu.u AS b, cu.u AS c, coalesce(lag(bu.u) OVER w, 0) AS b0, coalesce(lag(cu.u) OVER w, 0) AS c0
      FROM cu JOIN bu USING (source, i) WINDOW w AS (PARTITION BY cu.source, window_start ORDER BY i)),
s AS (SELECT source, window_start, greatest(b - b0, 1e-6) AS pb, greatest(c - c0, 1e-6) AS pc FROM j
      UNION ALL SELECT source, window_start, greatest(1 - b, 1e-6), greatest(1 - c, 1e-6) FROM j WHERE i = 9),
med AS (SELECT source, min(value) AS base_median, any_value(n) AS base_n FROM base WHERE rn * 2 >= n GROUP BY 1),
cm AS (SELECT source, window_start, min(value) AS median, any_value(n) AS n FROM (
         SELECT *, row_number() OVER (PARTITION BY source, window_start ORDER BY value) AS rn, count(*) OVER (PARTITION BY source, window_start) AS n FROM cur) x
       WHERE rn * 2 >= n GROUP BY 1, 2)
SELECT source, window_start, any_value(n) AS n, any_value(base_n) AS base_n, round(any_value(base_median), 6) AS base_median,
       round(any_value(median), 6) AS median, round(sum((pc - pb) * ln(pc / pb)), 6) AS psi, sum((pc - pb) * ln(pc / pb)) > 0.2 AS drift
FROM s JOIN med USING (source) JOIN cm USING (source, window_start) GROUP BY 1, 2""")
def drift_quantiles(spark, sf):
    """One sketch per source and day in one scan; the first ten days merged are the baseline of the others."""
    from tidemark.operators.sketches import merge_sketches, quantile_drift, window_sketches
    from tidemark.session import materialize
    days = materialize(window_sketches(tb.readings(spark, sf), ["source"], "timestamp", "1 day"), "sketches")
    cut = F.lit(days.agg(F.min("window_start")).first()[0]) + F.expr("INTERVAL 10 DAYS")
    base = merge_sketches(days.where(F.col("window_start") < cut), ["source"])
    out = quantile_drift(base, days.where(F.col("window_start") >= cut), ["source"])
    return out.select("source", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n", "base_n",
                      r6("base_median").alias("base_median"), r6("median").alias("median"), r6("psi").alias("psi"), "drift")


@register("pipeline_metrics", f"""
WITH good AS (SELECT time_bucket(INTERVAL '1 hour', timestamp) AS window_start, count(*) AS processed_count,
                     count(*) FILTER (WHERE is_anomaly) AS anomaly_count
              FROM ({ZRES_SQL}) r GROUP BY 1),
bad AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, count(*) AS bad_count FROM events
        WHERE event_type IS NULL OR value IS NULL OR isnan(value) OR ts IS NULL GROUP BY 1)
SELECT window_start, coalesce(processed_count, 0) AS processed_count, coalesce(anomaly_count, 0) AS anomaly_count,
       coalesce(bad_count, 0) AS bad_count, round(coalesce(processed_count, 0) / 3600.0, 6) AS rows_per_second,
       round(coalesce(anomaly_count / nullif(processed_count, 0), 0.0), 6) AS anomaly_rate,
       round(CAST(coalesce(coalesce(bad_count, 0) / nullif(coalesce(processed_count, 0) + coalesce(bad_count, 0), 0),
                           0.0) AS DOUBLE), 6) AS error_rate
FROM good FULL OUTER JOIN bad USING (window_start)""")
def pipeline_metrics_q(spark, sf):
    from tidemark.operators import aggregates as ag
    from tidemark.operators.quality import reading_reason, split_valid
    good, bad = split_valid(tb.readings(spark, sf), reading_reason(corrupt=None))
    res = st.rolling_zscore(good, EVENTS_BY_TYPE)
    out = ag.pipeline_metrics(res, bad, duration="1 hour")
    return out.select("window_start", "processed_count", "anomaly_count", "bad_count",
                      r6("rows_per_second").alias("rows_per_second"), r6("anomaly_rate").alias("anomaly_rate"),
                      r6("error_rate").alias("error_rate"))


@register("alert_rules", f"""
WITH m AS (SELECT time_bucket(INTERVAL '1 hour', timestamp) AS window_start, source, count(*) AS n,
                  count(*) FILTER (WHERE is_anomaly) / count(*) AS anomaly_rate
           FROM ({ZRES_SQL}) r GROUP BY 1, 2),
spine AS (SELECT source, unnest(generate_series((SELECT min(window_start) FROM m), (SELECT max(window_start) FROM m), INTERVAL '1 hour')) AS window_start
          FROM (SELECT DISTINCT source FROM m) s),
h AS (SELECT spine.window_start, spine.source, coalesce(n, 0) AS n, coalesce(anomaly_rate, 0.0) AS anomaly_rate
      FROM spine LEFT JOIN m USING (source, window_start))
SELECT 'high_anomaly_rate' AS rule, 'warning' AS severity, 'anomaly_rate > 0.1' AS condition,
       window_start, source, round(anomaly_rate, 6) AS anomaly_rate FROM h WHERE anomaly_rate > 0.1
UNION ALL
SELECT 'service_down', 'critical', 'service_health == 0', window_start, source, 0.0 FROM h WHERE n = 0""")
def alert_rules_q(spark, sf):
    from tidemark.operators import aggregates as ag
    from tidemark.operators.alerts import evaluate_rules, with_empty_windows
    res = zscore_results(spark, sf)
    m = ag.processing_statistics(res.withColumn("window_start", F.window("timestamp", "1 hour").start),
                                 ["window_start", "source"])
    m = with_empty_windows(m, "window_start", "1 hour", ["source"], ["processed_count", "anomaly_rate"])
    m = m.withColumn("service_health", (F.col("processed_count") > 0).cast("int"))
    a = evaluate_rules(m, keep=["window_start", "source", "anomaly_rate"])
    return a.withColumn("anomaly_rate", r6("anomaly_rate"))


@register("silent_sources", """
SELECT source, gap_start, gap_end, round(gap_minutes, 6) AS gap_minutes FROM (
  SELECT event_type AS source, lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS gap_start,
         ts AS gap_end,
         date_diff('microsecond', lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id), ts) / 60e6
           AS gap_minutes
  FROM events
  UNION ALL
  SELECT event_type, max(ts), (SELECT max(ts) FROM events) + INTERVAL 100 MINUTE,
         date_diff('microsecond', max(ts), (SELECT max(ts) FROM events) + INTERVAL 100 MINUTE) / 60e6
  FROM events GROUP BY 1) g
WHERE gap_minutes > 90""")
def silent_sources_q(spark, sf):
    from tidemark.operators.alerts import silent_sources
    ev = tb.readings(spark, sf)
    as_of = ev.agg(F.max("timestamp") + F.expr("INTERVAL 100 MINUTES")).first()[0]
    out = silent_sources(ev, gap_minutes=90, as_of=as_of)
    return out.withColumn("gap_minutes", r6("gap_minutes"))


# ---------------------------------------------------------------- A3-A5, A12, B1-B11, F5, G1, I4, M1 data preparation


@register("standard_scale", """
SELECT event_id, event_type AS source,
       round((value - avg(value) OVER (PARTITION BY event_type)) /
             CASE WHEN stddev_pop(value) OVER (PARTITION BY event_type) = 0 THEN 1.0
                  ELSE stddev_pop(value) OVER (PARTITION BY event_type) END, 6) AS value_scaled
FROM events""")
def standard_scale(spark, sf):
    from tidemark.operators import scaling
    ev = tb.readings(spark, sf)
    m = scaling.fit_standard(ev, "value", ["source"])
    return m.transform(ev).select("event_id", "source", r6("value_scaled").alias("value_scaled"))


@register("minmax_scale", """
SELECT event_id, event_type AS source,
       round(CASE WHEN max(value) OVER p = min(value) OVER p THEN 0.0
             ELSE (value - min(value) OVER p) / (max(value) OVER p - min(value) OVER p) END, 6) AS value_scaled
FROM events WINDOW p AS (PARTITION BY event_type)""")
def minmax_scale(spark, sf):
    from tidemark.operators import scaling
    ev = tb.readings(spark, sf)
    m = scaling.fit_minmax(ev, "value", ["source"])
    return m.transform(ev).select("event_id", "source", r6("value_scaled").alias("value_scaled"))


@register("rolling_features", f"""
SELECT event_id, event_type AS source, value,
       lag(value) OVER w0 AS prev_value, round(value - lag(value) OVER w0, 6) AS diff,
       {D6("avg(value) OVER w")} AS roll_mean, {D6("stddev_pop(value) OVER w")} AS roll_std,
       round(sin(hour(ts) * 2 * pi() / 24.0), 6) AS hour_sin, round(cos(hour(ts) * 2 * pi() / 24.0), 6) AS hour_cos
FROM events
WINDOW w0 AS (PARTITION BY event_type ORDER BY ts, event_id),
       w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND 1 PRECEDING)""")
def rolling_features_q(spark, sf):
    from tidemark.operators import scaling
    out = scaling.rolling_features(tb.readings(spark, sf), ["source"], ["timestamp", "event_id"],
                                   time_col="timestamp")
    return out.select("event_id", "source", "value", "prev_value", r6("diff").alias("diff"),
                      dec6("roll_mean").alias("roll_mean"), dec6("roll_std").alias("roll_std"),
                      r6("hour_sin").alias("hour_sin"), r6("hour_cos").alias("hour_cos"))


@register("inject_anomalies", f"""
SELECT event_id, injected_value AS value, is_anomaly, anomaly_kind, normal_value FROM ({INJECTED_SQL}) i""")
def inject_anomalies_q(spark, sf):
    return injected_events(spark, sf).select("event_id", "value", "is_anomaly", "anomaly_kind", "normal_value")


@register("hash_split", f"""
SELECT event_id, {_u("CAST(event_id AS VARCHAR)")} < 0.7 AS is_train FROM events""")
def hash_split_q(spark, sf):
    from tidemark.operators.split import hash_split
    return hash_split(tb.table(spark, sf, "events").select("event_id"), "event_id", 0.7)


@register("time_series_folds", """
WITH p AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, count(*) OVER () AS n
           FROM events),
f AS (SELECT unnest(range(5)) AS fold),
b AS (SELECT fold, n - (5 - fold) * (n // 6) AS s, n - (5 - fold - 1) * (n // 6) AS e
      FROM f, (SELECT max(n) AS n FROM p) nn)
SELECT fold::INTEGER AS fold, role, count(*) AS n_rows, min(event_id) AS first_id, max(event_id) AS last_id FROM (
  SELECT b.fold, 'train' AS role, p.event_id FROM p JOIN b ON p.pos < b.s
  UNION ALL
  SELECT b.fold, 'test' AS role, p.event_id FROM p JOIN b ON p.pos >= b.s AND p.pos < b.e) x
GROUP BY 1, 2""")
def time_series_folds_q(spark, sf):
    from tidemark.operators.split import fold_summary
    ev = tb.table(spark, sf, "events").select("event_id", "ts")
    return fold_summary(ev, ["ts", "event_id"], "event_id", k=5)


@register("union_labelled", """
SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS value, l.toxic = 1 AS is_anomaly
FROM labels l JOIN documents d USING (doc_id)""")
def union_labelled_q(spark, sf):
    from tidemark.operators.inject import union_labelled
    lab = tb.table(spark, sf, "labels")
    doc = tb.table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("value"))
    j = doc.join(lab.select("doc_id", "toxic"), "doc_id")
    return union_labelled(j.where("toxic = 0").drop("toxic"), j.where("toxic = 1").drop("toxic"))


@register("json_decode_props", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_decode_props(spark, sf):
    from tidemark.sources.decode import decode_json
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    ev = tb.table(spark, sf, "events").select("event_id", "props")
    return decode_json(ev, "props", schema, keep=("event_id",)).select("event_id", "data.k")


@register("message_roundtrip", """
SELECT event_type AS key, event_type AS source, 'user_' || CAST(user_id AS VARCHAR) AS metric, value,
       ts AS timestamp FROM events""")
def message_roundtrip(spark, sf):
    from tidemark.sources import decode as dc
    msgs = dc.encode_json(tb.readings(spark, sf).select("source", "value", "metric", "timestamp"), "source")
    dec = dc.flatten(dc.decode_json(msgs, "value", dc.READING, keep=("key",)))
    dec = dc.value_chain(dc.default_timestamp(dec), "value", ("data",))
    return dec.select("key", "source", "metric", "value",
                      dc.parse_timestamp(F.col("timestamp")).cast("timestamp_ntz").alias("timestamp"))


@register("value_default_chain", """
SELECT event_id, CASE WHEN event_type = 'view' THEN 0.0 ELSE value END AS value FROM events""")
def value_default_chain(spark, sf):
    """Messages carry the reading under ``value``, under ``data`` (odd users),
    or not at all (event type 'view'); the chain value -> data -> 0 recovers it."""
    from pyspark.sql import types as T
    from tidemark.sources import decode as dc
    ev = tb.table(spark, sf, "events")
    # to_json omits NULL fields, so absent keys stay absent in the text
    view, odd = F.col("event_type") == "view", F.col("user_id") % 2 == 1
    body = F.struct(F.col("event_id"), F.when(~view & ~odd, F.col("value")).alias("value"),
                    F.when(~view & odd, F.col("value")).alias("data"))
    msgs = ev.select(F.to_json(body).alias("value"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType()),
                           T.StructField("data", T.DoubleType())])
    dec = dc.flatten(dc.decode_json(msgs, "value", schema))
    return dc.value_chain(dec, "value", ("data",)).select("event_id", "value")


@register("quarantine_split", """
SELECT coalesce(CASE WHEN json_valid(props) IS NOT TRUE THEN 'malformed_json'
                     WHEN event_type IS NULL THEN 'missing_source'
                     WHEN value IS NULL THEN 'missing_value'
                     WHEN isnan(value) THEN 'nan_value'
                     WHEN ts IS NULL THEN 'missing_timestamp' END, 'ok') AS status, count(*) AS n
FROM events GROUP BY 1""")
def quarantine_split_q(spark, sf):
    from tidemark.operators.quality import reading_reason, split_valid
    ev = tb.table(spark, sf, "events")
    ok_json = F.get_json_object("props", "$").isNotNull()
    ev = ev.withColumn("_corrupt", ~F.coalesce(ok_json, F.lit(False)))
    good, bad = split_valid(ev, reading_reason("value", "ts", "event_type", "_corrupt"))
    g = good.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit("ok").alias("status"), "n").where("n > 0")
    b = bad.groupBy(F.col("reason").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return g.unionByName(b)


@register("schema_enforcement", f"""
SELECT CASE WHEN source IS NULL THEN 'missing_source' WHEN value IS NULL THEN 'missing_value'
            WHEN timestamp IS NULL THEN 'missing_timestamp' ELSE 'ok' END AS status,
       count(*) AS n, count(*) FILTER (WHERE is_anomaly) AS n_anomalous
FROM ({ZRES_SQL}) r GROUP BY 1""")
def schema_enforcement(spark, sf):
    from tidemark.operators.quality import enforce_schema
    from tidemark.sources.decode import ALERT
    from tidemark.sources.sinks import alerts_view
    raw = alerts_view(zscore_results(spark, sf)).select(*[F.col(c).cast("string") for c in ALERT.fieldNames()])
    typed = enforce_schema(raw, ALERT, ["source", "value", "timestamp", "is_anomaly"])
    return (typed.groupBy(F.coalesce("reason", F.lit("ok")).alias("status"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anomaly").alias("n_anomalous")))


@register("result_envelope_json", f"""
SELECT source AS key, source, metric, value, is_anomaly, round(anomaly_score, 6) AS anomaly_score, anomaly_type,
       strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp
FROM ({ZRES_SQL}) r""")
def result_envelope_json(spark, sf):
    from tidemark.sources import decode as dc
    from tidemark.sources.sinks import alerts_view
    msgs = dc.encode_json(alerts_view(zscore_results(spark, sf)), "source")
    dec = dc.flatten(dc.decode_json(msgs, "value", dc.ALERT, keep=("key",)))
    return dec.select("key", "source", "metric", "value", "is_anomaly", r6("anomaly_score").alias("anomaly_score"),
                      "anomaly_type", "timestamp")


@register("csv_roundtrip", """
SELECT event_type AS source, value, 'user_' || CAST(user_id AS VARCHAR) AS metric,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp FROM events""")
def csv_roundtrip(spark, sf):
    from tidemark.session import scratch_path
    from tidemark.sources import files
    path = scratch_path(spark, "readings-csv")
    ev = tb.readings(spark, sf).select("source", "value", "metric",
                                       F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"))
    files.write_csv(ev, path)
    return files.read_csv(spark, path).drop(files.CORRUPT)


# ---------------------------------------------------------------- D6-D9, I3 evaluation


EVAL_SQL = _zscore_sql("event_id, is_anomaly AS label, injected_value AS value",
                       INJECTED_SQL, "source",
                       "timestamp, event_id", "injected_value", digits=None)


def evaluated_events(spark, sf):
    inj = injected_events(spark, sf).withColumnRenamed("is_anomaly", "label")
    return st.rolling_zscore(inj, EVENTS_BY_TYPE)


@register("confusion_matrix", f"""
SELECT label, is_anomaly AS prediction, count(*) AS count FROM ({EVAL_SQL}) e GROUP BY 1, 2""")
def confusion_matrix_q(spark, sf):
    from tidemark.operators.evaluate import confusion_cells
    return confusion_cells(evaluated_events(spark, sf), "label", "is_anomaly").where("count > 0")


@register("classification_report", f"""
WITH c AS (SELECT count(*) FILTER (WHERE NOT label AND NOT is_anomaly) AS tn,
                  count(*) FILTER (WHERE NOT label AND is_anomaly) AS fp,
                  count(*) FILTER (WHERE label AND NOT is_anomaly) AS fn,
                  count(*) FILTER (WHERE label AND is_anomaly) AS tp FROM ({EVAL_SQL}) e),
m AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
             coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
             tn + fp + fn + tp AS n FROM c)
SELECT round((p0 * (tn + fp) + p1 * (tp + fn)) / n, 6) AS precision,
       round((r0 * (tn + fp) + r1 * (tp + fn)) / n, 6) AS recall,
       round((coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) * (tn + fp)
            + coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) * (tp + fn)) / n, 6) AS f1_score,
       round((tn + tp) / n, 6) AS accuracy, n AS support, tn, fp, fn, tp
FROM m""")
def classification_report_q(spark, sf):
    from tidemark.operators.evaluate import classification_report
    rep = classification_report(evaluated_events(spark, sf), "label", "is_anomaly")
    cm = F.col("confusion_matrix")
    return rep.select(*[r6(c).alias(c) for c in ("precision", "recall", "f1_score", "accuracy")], "support",
                      cm[0][0].alias("tn"), cm[0][1].alias("fp"), cm[1][0].alias("fn"), cm[1][1].alias("tp"))


@register("unlabelled_metrics", f"""
SELECT round(avg(CASE WHEN is_anomaly THEN 1.0 ELSE 0.0 END), 6) AS anomaly_rate,
       round(avg(anomaly_score), 6) AS avg_score, round(stddev_pop(anomaly_score), 6) AS score_std
FROM ({ZRES_SQL}) r""")
def unlabelled_metrics_q(spark, sf):
    from tidemark.operators.evaluate import unlabelled_metrics
    m = unlabelled_metrics(zscore_results(spark, sf))
    return m.select(*[r6(c).alias(c) for c in m.columns])


@register("contamination_threshold", """
SELECT event_type AS source, round(quantile_cont(value, 0.9), 6) AS threshold FROM events GROUP BY 1""")
def contamination_threshold(spark, sf):
    from tidemark.operators.quantile import exact_percentile
    out = exact_percentile(tb.readings(spark, sf), "value", 0.9, ["source"], out="threshold")
    return out.select("source", r6("threshold").alias("threshold"))


# ---------------------------------------------------------------- H2-H5 detectors


@register("isolation_forest_scores")
def isolation_forest_scores(spark, sf):
    from tidemark.operators.isolation_forest import IsolationForestDetector
    m = IsolationForestDetector(GLOBAL_EVENTS, contamination=0.1).fit(tb.readings(spark, sf))
    out = m.transform(tb.readings(spark, sf))
    return out.select("event_id", "is_anomaly", r6("anomaly_score").alias("anomaly_score"))


ORACLE["isolation_forest_scores"] = _iforest_sql(
    "SELECT event_id AS id, value AS x FROM events", "SELECT event_id AS id, value AS x FROM events")


@register("one_class_svm_scores")
def one_class_svm_scores(spark, sf):
    from tidemark.operators.ocsvm import OneClassSVMDetector
    m = OneClassSVMDetector(GLOBAL_EVENTS, nu=0.1).fit(tb.readings(spark, sf))
    out = m.transform(tb.readings(spark, sf))
    return out.select("event_id", "is_anomaly", r6("anomaly_score").alias("anomaly_score"))


def _svm_sql(src: str, nu: float, D: int, steps: int, seed: int = 42) -> str:
    """The sub-gradient steps of the one-class SVM, unrolled: ``s{t}`` holds the weights and rho after step t."""
    from tidemark.operators.ocsvm import random_features
    W, B = random_features(D, 1.0, seed)
    scale = repr((2.0 / D) ** 0.5)
    js = range(D)
    phi = ", ".join(f"{scale} * cos((x - m) / sd * {float(W[j])!r} + {float(B[j])!r}) AS p{j}" for j in js)
    dot = " + ".join(f"p{j} * a{j}" for j in js)
    ctes = [f"src AS ({src})",
            "st AS (SELECT avg(x) AS m, CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS sd FROM src)",
            f"p AS MATERIALIZED (SELECT id, {phi} FROM src, st)",
            f"w0 AS (SELECT {', '.join(f'avg(p{j}) AS a{j}' for j in js)} FROM p)",
            f"s0 AS MATERIALIZED (SELECT *, {' + '.join(f'a{j} * a{j}' for j in js)} AS rho FROM w0)"]
    for t in range(1, steps + 1):
        eta = repr(1.0 / (t + 1.0))
        cols = ", ".join(f"any_value(a{j}) - {eta} * (any_value(a{j}) - coalesce(sum(p{j}) FILTER (WHERE v), 0) / ({nu} * count(*))) AS a{j}" for j in js)
        ctes.append(f"s{t} AS MATERIALIZED (SELECT {cols}, any_value(rho) - {eta} * (count(*) FILTER (WHERE v) / count(*) - {nu}) AS rho "
                    f"FROM (SELECT *, {dot} < rho AS v FROM p, s{t - 1}) x)")
    return (f"WITH {', '.join(ctes)}, f AS (SELECT id, {dot} AS f FROM p, s{steps}), q AS (SELECT quantile_cont(f, {nu}) AS r FROM f) "
            "SELECT id AS event_id, f - r < 0 AS is_anomaly, round(least(greatest(r - f, 0), 1), 6) AS anomaly_score FROM f, q")


@register("one_class_svm_steps", _svm_sql("SELECT event_id AS id, value AS x FROM events", 0.1, 16, 20))
def one_class_svm_steps(spark, sf):
    """A fixed number of distributed steps on 16 features, the same as the unrolled SQL."""
    from tidemark.operators.ocsvm import OneClassSVMDetector
    m = OneClassSVMDetector(GLOBAL_EVENTS, nu=0.1, n_components=16, max_iter=20, tol=0.0).fit(tb.readings(spark, sf))
    out = m.transform(tb.readings(spark, sf))
    return out.select("event_id", "is_anomaly", r6("anomaly_score").alias("anomaly_score"))


def _lof_sql(train: str, score: str, k: int = 20, contamination: float = 0.1) -> str:
    """(event_id, dec): the decision of LOF with neighbours in rank order, fitted on ``train`` and applied to ``score`` (both id, x)."""
    return f"""
WITH tr AS ({train}), te AS ({score}),
sdv AS (SELECT CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS sd FROM tr),
p AS (SELECT id, x, row_number() OVER (ORDER BY x, id) AS rn FROM tr),
c AS (SELECT a.rn, b.rn AS nrn, abs(a.x - b.x) AS dr
      FROM p a JOIN p b ON b.rn BETWEEN a.rn - {k} AND a.rn + {k} AND b.rn <> a.rn),
nb AS (SELECT rn, nrn, dr / (SELECT sd FROM sdv) AS d
       FROM (SELECT *, row_number() OVER (PARTITION BY rn ORDER BY dr, nrn) AS j FROM c) c2 WHERE j <= {k}),
kd AS (SELECT rn, max(d) AS kd FROM nb GROUP BY rn),
lrd AS (SELECT nb.rn, 1.0 / (avg(greatest(nb.d, kd.kd)) + 1e-10) AS lrd
        FROM nb JOIN kd ON kd.rn = nb.nrn GROUP BY nb.rn),
tl AS (SELECT nb.rn, avg(l2.lrd) / any_value(l1.lrd) AS lof
       FROM nb JOIN lrd l2 ON l2.rn = nb.nrn JOIN lrd l1 ON l1.rn = nb.rn GROUP BY nb.rn),
off AS (SELECT quantile_cont(-lof, {contamination}) AS off_v FROM tl),
u AS (SELECT x, 0 AS f, rn AS id FROM p UNION ALL SELECT x, 1 AS f, id FROM te),
r AS (SELECT id, x, r FROM (
        SELECT id, x, f, row_number() OVER (ORDER BY x, f, id)
                         - row_number() OVER (PARTITION BY f ORDER BY x, id) AS r FROM u) u2 WHERE f = 1),
nc AS (SELECT r.id, p.rn, abs(p.x - r.x) AS dr FROM r JOIN p ON p.rn BETWEEN r.r - {k - 1} AND r.r + {k}),
nn AS (SELECT id, rn, dr / (SELECT sd FROM sdv) AS d
       FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dr, rn) AS j FROM nc) n2 WHERE j <= {k}),
sc AS (SELECT nn.id, avg(lrd.lrd) * (avg(greatest(nn.d, kd.kd)) + 1e-10) AS lof
       FROM nn JOIN kd ON kd.rn = nn.rn JOIN lrd ON lrd.rn = nn.rn GROUP BY nn.id)
SELECT id AS event_id, -lof - off_v AS dec FROM sc, off"""


_EVENT_VALUES = "SELECT event_id AS id, value AS x FROM events"


LOF_SQL = (f"SELECT event_id, dec < 0 AS is_anomaly, round(1 - dec, 6) AS reference_score FROM "
           f"({_lof_sql(_EVENT_VALUES, _EVENT_VALUES)}) l")


@register("lof_scores", LOF_SQL)
def lof_scores(spark, sf):
    from tidemark.operators.lof import LOFDetector
    m = LOFDetector(GLOBAL_EVENTS, contamination=0.1, n_neighbors=20).fit(tb.readings(spark, sf))
    out = m.transform(tb.readings(spark, sf))
    return out.select("event_id", "is_anomaly", r6("reference_score").alias("reference_score"))


ZS_SQL = _zscore_sql("event_id", EVENTS_BY_TYPE_SQL, "source", "timestamp, event_id", "value", digits=None)


IQ_SQL = _iqr_sql("event_id", EVENTS_BY_TYPE_SQL, "source", "timestamp, event_id", "value", digits=None)


@register("ensemble_scores", f"""
SELECT z.event_id, (0.6 * z.anomaly_score + 0.4 * q.anomaly_score) / 1.0 > 0.5 AS is_anomaly,
       round((0.6 * z.anomaly_score + 0.4 * q.anomaly_score) / 1.0, 6) AS anomaly_score,
       z.is_anomaly AS zscore_flag, q.is_anomaly AS iqr_flag, 'ensemble' AS anomaly_type
FROM ({ZS_SQL}) z JOIN ({IQ_SQL}) q USING (event_id)""")
def ensemble_scores(spark, sf):
    from tidemark.operators.ensemble import EnsembleModel
    from tidemark.operators.statistical import StatisticalDetector
    members = {"zscore": StatisticalDetector(EVENTS_BY_TYPE, "zscore").model(),
               "iqr": StatisticalDetector(EVENTS_BY_TYPE, "iqr").model()}
    out = EnsembleModel(members, {"zscore": 0.6, "iqr": 0.4}, 0.5, False).transform(tb.readings(spark, sf))
    dr = F.col("detector_results")
    return out.select("event_id", "is_anomaly", r6("anomaly_score").alias("anomaly_score"),
                      dr["zscore"]["is_anomaly"].alias("zscore_flag"), dr["iqr"]["is_anomaly"].alias("iqr_flag"),
                      "anomaly_type")


def _default_ensemble_sql(columns: str = "z.event_id") -> str:
    """The configured ensemble: forest 0.4, LOF 0.3, rolling z-score 0.3."""
    forest = _iforest_sql(_EVENT_VALUES, _EVENT_VALUES, contamination=0.1, digits=None)
    z = _zscore_sql("event_id, source, value", EVENTS_BY_TYPE_SQL, "source", "timestamp, event_id", "value", digits=None)
    score = "(0.4 * f.anomaly_score + 0.3 * least(greatest(-l.dec, 0), 1) + 0.3 * z.anomaly_score)"
    return f"""
SELECT {columns}, {score} > 0.5 AS is_anomaly, round({score}, 6) AS anomaly_score, 'ensemble' AS anomaly_type,
       z.is_anomaly AS zscore_flag, l.dec < 0 AS lof_flag, f.is_anomaly AS forest_flag
FROM ({z}) z JOIN ({forest}) f USING (event_id) JOIN ({_lof_sql(_EVENT_VALUES, _EVENT_VALUES)}) l USING (event_id)"""


def _default_members(spark, sf):
    """The three members: forest and LOF fitted on all events, rolling z-score per source with empty buffers."""
    from tidemark.operators.isolation_forest import IsolationForestDetector
    from tidemark.operators.lof import LOFDetector
    ev = tb.readings(spark, sf)
    return {"isolation_forest": IsolationForestDetector(GLOBAL_EVENTS, contamination=0.1).fit(ev),
            "lof": LOFDetector(GLOBAL_EVENTS, contamination=0.1, n_neighbors=20).fit(ev),
            "statistical": st.StatisticalDetector(EVENTS_BY_TYPE, "zscore").model()}


DEFAULT_WEIGHTS = {"isolation_forest": 0.4, "lof": 0.3, "statistical": 0.3}


def _ensemble_columns(out, *first: str):
    dr = F.col("detector_results")
    return out.select(*first, "is_anomaly", r6("anomaly_score").alias("anomaly_score"), "anomaly_type",
                      *[dr[m]["is_anomaly"].alias(n) for m, n in (("statistical", "zscore_flag"), ("lof", "lof_flag"),
                                                                  ("isolation_forest", "forest_flag"))])


@register("ensemble_default", _default_ensemble_sql())
def ensemble_default(spark, sf):
    from tidemark.operators.ensemble import EnsembleModel
    model = EnsembleModel(_default_members(spark, sf), DEFAULT_WEIGHTS, 0.5, False)
    return _ensemble_columns(model.transform(tb.readings(spark, sf)), "event_id")


@register("registry_ensemble", _default_ensemble_sql())
def registry_ensemble(spark, sf):
    """The default ensemble saved twice, the later version loaded by name and applied."""
    from tidemark.operators.ensemble import EnsembleModel
    from tidemark.plans import registry
    from tidemark.session import scratch_path
    root, members = scratch_path(spark, "registry"), _default_members(spark, sf)
    registry.save_model(spark, EnsembleModel(members, {"statistical": 1.0}, 0.9, False), root, "default")
    registry.save_model(spark, EnsembleModel(members, DEFAULT_WEIGHTS, 0.5, False), root, "default")
    return _ensemble_columns(registry.load_latest(spark, root, "default").transform(tb.readings(spark, sf)), "event_id")


@register("registry_baseline", """
WITH b AS (SELECT event_type AS source, avg(value) AS m, stddev_pop(value) AS sd FROM events GROUP BY 1)
SELECT event_id, coalesce(sd > 0 AND abs((value - m) / sd) > 3.0, false) AS is_anomaly,
       round(CASE WHEN sd > 0 THEN least(abs((value - m) / sd) / 3.0, 1.0) ELSE 0.0 END, 6) AS anomaly_score
FROM events JOIN b ON event_type = source""")
def registry_baseline(spark, sf):
    """The per-source baseline, saved, loaded by name and applied."""
    from tidemark.plans import registry
    from tidemark.session import scratch_path
    from tidemark.streaming.scoring import BaselineModel
    root = scratch_path(spark, "registry")
    registry.save_model(spark, BaselineModel.fit(tb.readings(spark, sf), ["source"], "value", 3.0), root, "baseline")
    out = registry.load_latest(spark, root, "baseline").transform(tb.readings(spark, sf))
    return out.select("event_id", "is_anomaly", r6("anomaly_score").alias("anomaly_score"))


# ---------------------------------------------------------------- I1-I5, A9-A10 training, selection, registry


def _train_many_sql() -> str:
    split = _u("CAST(event_id AS VARCHAR)") + " < 0.7"
    inj = f"SELECT *, {split} AS is_train FROM ({INJECTED_SQL}) i"
    train = f"SELECT event_id AS id, injected_value AS x FROM ({inj}) t WHERE is_train"
    valid = f"SELECT event_id AS id, injected_value AS x FROM ({inj}) v WHERE NOT is_train"
    forest = _iforest_sql(train, valid, contamination=0.05, digits=None)
    # statistical member: training rows are the buffer history, validation rows are scored after them
    seeded = f"SELECT event_id, timestamp, source, injected_value, is_anomaly AS label, CASE WHEN is_train THEN 0 ELSE 1 END AS seg FROM ({inj}) u"
    z = _zscore_sql("event_id, seg, label", seeded, "source", "seg, timestamp, event_id", "injected_value",
                    digits=None)
    zval = f"SELECT event_id, label, is_anomaly AS pred, anomaly_score AS s FROM ({z}) z WHERE seg = 1"
    fval = (f"SELECT f.event_id, i.is_anomaly AS label, f.is_anomaly AS pred, f.anomaly_score AS s "
            f"FROM ({forest}) f JOIN ({INJECTED_SQL}) i USING (event_id)")
    lof = _lof_sql(train, valid, contamination=0.05)
    lval = (f"SELECT l.event_id, i.is_anomaly AS label, l.dec < 0 AS pred, least(greatest(-l.dec, 0), 1) AS s "
            f"FROM ({lof}) l JOIN ({INJECTED_SQL}) i USING (event_id)")
    ens = (f"SELECT z.event_id, z.label, (0.4 * f.s + 0.3 * l.s + 0.3 * z.s) > 0.5 AS pred "
           f"FROM ({zval}) z JOIN ({fval}) f USING (event_id) JOIN ({lval}) l USING (event_id)")
    parts = [(0, "isolation_forest", fval), (1, "statistical", zval), (2, "lof", lval), (3, "ensemble", ens)]
    return " UNION ALL ".join(
        f"SELECT {i} AS trial_order, '{name}' AS model_type, r.*, CAST(NULL AS VARCHAR) AS error "
        f"FROM ({_report_sql(src)}) r" for i, name, src in parts)


TRAIN_MANY_SQL = _train_many_sql()


@register("train_many")
def train_many_q(spark, sf):
    from tidemark.operators.split import hash_split
    from tidemark.plans.training import train_many
    data = hash_split(_labelled_events(spark, sf), "event_id", 0.7)
    spec = SeriesSpec(("source",), ("timestamp", "event_id"), "value", "event_id")
    lof = {"contamination": 0.05, "n_neighbors": 20}
    cfgs = {"ensemble": {"detectors": {"isolation_forest": {"contamination": 0.05}, "lof": lof,
                                       "statistical": {"method": "zscore", "threshold": 3.0}},
                         "weights": DEFAULT_WEIGHTS, "threshold": 0.5},
            "isolation_forest": {"contamination": 0.05}, "lof": lof}
    res, _ = train_many(spark, data.where("is_train").drop("is_train"), data.where("not is_train").drop("is_train"),
                        ["isolation_forest", "statistical", "lof", "ensemble"], cfgs, spec)
    return res.select("trial_order", "model_type", *[r6(c).alias(c) for c in
                                                     ("precision", "recall", "f1_score", "accuracy")], "error")


ORACLE["train_many"] = TRAIN_MANY_SQL


@register("auto_select")
def auto_select_q(spark, sf):
    from tidemark.plans.training import auto_select
    return auto_select(train_many_q(spark, sf).withColumn("error", F.col("error")))


ORACLE["auto_select"] = f"""
SELECT model_type AS best_model, f1_score AS best_score FROM ({TRAIN_MANY_SQL}) t
WHERE error IS NULL ORDER BY f1_score DESC, trial_order LIMIT 1"""


GRID = {"threshold": [2.5, 3.0], "window_size": [50, 100]}


def _grid_sql() -> str:
    import itertools
    import json
    parts = []
    for th, ws in itertools.product(GRID["threshold"], GRID["window_size"]):
        ptxt = json.dumps({"threshold": th, "window_size": ws}, sort_keys=True)
        z = _zscore_sql("event_id, timestamp, is_anomaly AS label", INJECTED_SQL, "source", "timestamp, event_id",
                        "injected_value", window=ws, thr=th, digits=None)
        parts.append(f"SELECT '{ptxt}' AS params, event_id, timestamp, label, is_anomaly FROM ({z}) z{len(parts)}")
    u = " UNION ALL ".join(parts)
    return f"""
WITH s AS ({u}),
p AS (SELECT *, row_number() OVER (PARTITION BY params ORDER BY timestamp, event_id) - 1 AS pos,
             count(*) OVER (PARTITION BY params) AS n FROM s),
f AS (SELECT *, CAST(floor((pos - (n - 5 * (n // 6))) / (n // 6)) AS INTEGER) AS fold FROM p
      WHERE pos >= n - 5 * (n // 6))
SELECT params, fold,
       round(CASE WHEN 2 * count(*) FILTER (WHERE label AND is_anomaly) + count(*) FILTER (WHERE label <> is_anomaly) = 0
             THEN 0.0 ELSE 2.0 * count(*) FILTER (WHERE label AND is_anomaly) /
             (2 * count(*) FILTER (WHERE label AND is_anomaly) + count(*) FILTER (WHERE label <> is_anomaly)) END, 6)
         AS f1
FROM f GROUP BY 1, 2"""


@register("grid_search", _grid_sql())
def grid_search_q(spark, sf):
    from tidemark.plans.training import grid_search
    data = _labelled_events(spark, sf).withColumnRenamed("is_anomaly", "label")
    spec = SeriesSpec(("source",), ("timestamp", "event_id"), "value", "event_id")
    cv, _best = grid_search(spark, "statistical", data, GRID, spec, label_column="label")
    return cv.select("params", "fold", r6("f1").alias("f1"))


@register("model_registry_latest")
def model_registry_latest(spark, sf):
    from tidemark.operators.isolation_forest import IsolationForestDetector
    from tidemark.operators.statistical import StatisticalDetector
    from tidemark.plans import registry
    from tidemark.session import scratch_path
    root = scratch_path(spark, "registry")
    train = tb.readings(spark, sf)
    registry.save_model(spark, StatisticalDetector(EVENTS_BY_TYPE).fit(None), root, "zscore")
    registry.save_model(spark, StatisticalDetector(EVENTS_BY_TYPE, threshold=2.5).fit(None), root, "zscore")
    registry.save_model(spark, IsolationForestDetector(GLOBAL_EVENTS, n_estimators=20).fit(train), root, "forest")
    latest = registry.latest(spark, root)
    return latest.select("name", "model_type", F.col("version").cast("bigint").alias("version"))


# ---------------------------------------------------------------- K1-K10 streaming (each runs to completion with availableNow)


def _events_stream(spark, sf, path: str | None = None, max_files: int | None = None):
    """The events table as a file stream (a glob: file streams read directories)."""
    from tidemark.streaming.stats import read_stream
    schema = tb.table(spark, sf, "events").schema
    src = path or f"{sf}/events.parque[t]"
    s = read_stream(spark, "parquet", src, schema, max_files_per_trigger=max_files)
    return s.select("event_id", F.col("ts").alias("timestamp"), F.col("event_type").alias("source"),
                    F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("metric"), "value")


def _run_to_table(spark, df, name: str, mode: str = "append"):
    from tidemark.session import scratch_path
    out, ck = scratch_path(spark, name), scratch_path(spark, name + "-ckpt")
    q = (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", ck)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    return spark.read.parquet(out)


BASELINE_SQL = """
WITH b AS (SELECT event_type, avg(value) AS m, stddev_pop(value) AS sd FROM events GROUP BY 1)
SELECT e.event_id, e.ts AS timestamp, e.event_type AS source, 'user_' || CAST(e.user_id AS VARCHAR) AS metric,
       e.value, coalesce(b.sd > 0 AND abs((e.value - b.m) / b.sd) > 3.0, false) AS is_anomaly,
       CASE WHEN b.sd > 0 THEN least(abs((e.value - b.m) / b.sd) / 3.0, 1.0) ELSE 0.0 END AS anomaly_score
FROM events e JOIN b USING (event_type)"""


@register("stream_window_stats", f"""
WITH w AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
                  time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, event_type AS source,
                  {D6("avg(value)")} AS avg_value, {D6("stddev_samp(value)")} AS std_value, count(value) AS count
           FROM events GROUP BY 1, 2, 3)
SELECT * FROM w WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 30 SECOND""")
def stream_window_stats(spark, sf):
    from tidemark.streaming.stats import event_time, window_stats
    s = event_time(_events_stream(spark, sf), "timestamp")
    ws = window_stats(s, "event_time", "1 hour", "30 seconds", ["source"])
    out = _run_to_table(spark, ws, "stream-window-stats")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "source",
                      dec6("avg_value").alias("avg_value"), dec6("std_value").alias("std_value"), "count")


@register("stream_window_stats_1m", f"""
WITH w AS (SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start,
                  time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute' AS window_end,
                  event_type AS source, 'user_' || CAST(user_id AS VARCHAR) AS metric,
                  {D6("avg(value)")} AS avg_value, {D6("stddev_samp(value)")} AS std_value, count(value) AS count
           FROM events GROUP BY 1, 2, 3, 4)
SELECT * FROM w WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 30 SECOND""")
def stream_window_stats_1m(spark, sf):
    """The original streaming statistics: 1-minute windows, 30 s watermark,
    per (source, metric), on event time."""
    from tidemark.streaming.stats import event_time, window_stats
    s = event_time(_events_stream(spark, sf), "timestamp")
    ws = window_stats(s, "event_time", "1 minute", "30 seconds", ["source", "metric"])
    out = _run_to_table(spark, ws, "stream-window-stats-1m")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "source", "metric",
                      dec6("avg_value").alias("avg_value"), dec6("std_value").alias("std_value"), "count")


@register("stream_zscore",
          _zscore_sql("event_id, source, value", EVENTS_BY_TYPE_SQL, "source", "timestamp, event_id", "value"))
def stream_zscore(spark, sf):
    from tidemark.session import scratch_path
    from tidemark.streaming.stats import write_time_ordered
    from tidemark.streaming.stateful import rolling_detector_stream
    replay = scratch_path(spark, "events-replay")
    write_time_ordered(tb.table(spark, sf, "events"), "ts", replay, 4)
    s = _events_stream(spark, sf, path=f"{replay}/part=*", max_files=1)
    scored = rolling_detector_stream(s, ["source"], ["timestamp", "event_id"], "value", "zscore", 3.0, 100, 10)
    out = _run_to_table(spark, scored, "stream-zscore")
    return out.select("event_id", "source", "value", *detection_cols())


def _heartbeat(rows, time_col: str, ahead: str):
    """One row without any value, later than all others: lets the watermark of a finished replay pass them.
    Its id is -1, as a join leaves out rows without one before they move the watermark."""
    late = rows.agg((F.max(time_col) + F.expr(f"INTERVAL {ahead}")).alias(time_col))
    return late.select(*[F.col(time_col) if f.name == time_col else F.lit(-1 if f.name == "event_id" else None).cast(f.dataType).alias(f.name)
                         for f in rows.schema])


def _out_of_order_events(spark, sf, nulls: bool = False):
    """The events as a stream in which odd ids arrive before even ids, in two time slices, and a heartbeat at the end."""
    from tidemark.session import scratch_path
    from tidemark.streaming.stats import read_stream
    value = _broken_value() if nulls else F.col("value")
    ev = tb.readings(spark, sf).select("event_id", F.col("timestamp").cast("timestamp").alias("event_time"),
                                       "source", value.alias("value"))
    replay = scratch_path(spark, "events-ooo")
    lo, hi = ev.agg(F.min(F.col("event_time").cast("double")), F.max(F.col("event_time").cast("double"))).first()
    step, i = (hi - lo) / 2, 0
    for k in range(2):
        t = F.col("event_time").cast("double")
        sl = ev.where((t >= lo + k * step) & ((t < lo + (k + 1) * step) if k == 0 else F.lit(True)))
        for par in (1, 0):
            sl.where(F.col("event_id") % 2 == par).coalesce(1).write.parquet(f"{replay}/p{i}")
            i += 1
    _heartbeat(ev, "event_time", "60 days").coalesce(1).write.parquet(f"{replay}/p{i}")
    return read_stream(spark, "parquet", f"{replay}/p*", ev.schema, max_files_per_trigger=1)


def _broken_value():
    """The value, NULL or NaN for some rows chosen by id."""
    return (F.when(F.col("event_id") % 53 == 0, F.lit(None).cast("double")).when(F.col("event_id") % 47 == 0, F.lit(float("nan")))
            .otherwise(F.col("value")))


BROKEN_SQL = ("SELECT event_id, ts AS timestamp, event_type AS source, "
              "CASE WHEN event_id % 53 = 0 OR event_id % 47 = 0 THEN NULL ELSE value END AS value FROM events")


ORACLE["drift_nulls"] = DRIFT_NULLS_SQL.format(BROKEN=BROKEN_SQL)


@register("rolling_zscore_nulls", "SELECT event_id, source, coalesce(is_anomaly, false) AS is_anomaly, "
          "CASE WHEN is_anomaly IS NULL THEN 0.0 ELSE anomaly_score END AS anomaly_score, anomaly_type FROM ("
          + _zscore_sql("event_id, source", BROKEN_SQL, "source", "timestamp, event_id", "value") + ") z")
def rolling_zscore_nulls(spark, sf):
    ev = tb.readings(spark, sf).withColumn("value", _broken_value())
    return st.rolling_zscore(ev, EVENTS_BY_TYPE).select("event_id", "source", *detection_cols())


@register("stream_zscore_nulls", "SELECT event_id, source, coalesce(is_anomaly, false) AS is_anomaly, "
          "CASE WHEN is_anomaly IS NULL THEN 0.0 ELSE anomaly_score END AS anomaly_score, anomaly_type FROM ("
          + _zscore_sql("event_id, source", BROKEN_SQL, "source", "timestamp, event_id", "value") + ") z")
def stream_zscore_nulls(spark, sf):
    from tidemark.streaming.timers import rolling_detector_event_time
    scored = rolling_detector_event_time(_out_of_order_events(spark, sf, nulls=True), ["source"], "event_time", "event_id",
                                         "value", "zscore", watermark="30 days")
    return _run_to_table(spark, scored, "stream-zscore-nulls").select("event_id", "source", *detection_cols())


@register("stream_zscore_event_time",
          _zscore_sql("event_id, source, value", EVENTS_BY_TYPE_SQL, "source", "timestamp, event_id", "value"))
def stream_zscore_event_time(spark, sf):
    """Out-of-order replay (per time slice, odd ids arrive before even ids): rows wait in state for the
    watermark, timers score them in event-time order, and a heartbeat at the end lets all of them out."""
    from tidemark.streaming.timers import rolling_detector_event_time
    scored = rolling_detector_event_time(_out_of_order_events(spark, sf), ["source"], "event_time", "event_id", "value",
                                         "zscore", watermark="30 days")
    out = _run_to_table(spark, scored, "stream-zscore-et")
    return out.select("event_id", "source", "value", *detection_cols())


@register("stream_service_down", """
SELECT source, ts AS last_seen, ts + INTERVAL 90 MINUTE AS due FROM (
  SELECT event_type AS source, ts, lead(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS following FROM events) g
WHERE following IS NULL OR date_diff('microsecond', ts, following) > 5400000000""")
def stream_service_down(spark, sf):
    """Silences longer than 90 minutes, told by timers; the heartbeat shows that every source has stopped at the end."""
    from tidemark.streaming.timers import silent_sources_stream
    down = silent_sources_stream(_out_of_order_events(spark, sf), ["source"], "event_time", "90 minutes", "30 days")
    out = _run_to_table(spark, down, "service-down").where("source IS NOT NULL")
    return out.select("source", F.col("last_seen").cast("timestamp_ntz").alias("last_seen"), F.col("due").cast("timestamp_ntz").alias("due"))


@register("stream_accuracy", f"""
WITH p AS (SELECT event_id, source, timestamp, is_anomaly FROM ({BASELINE_SQL}) s),
l AS (SELECT event_id, event_id % 7 = 0 OR value > 200 AS label FROM events WHERE (event_id * 7) % 120 <= 60 AND event_id % 5 <> 0),
j AS (SELECT time_bucket(INTERVAL '1 day', timestamp) AS window_start, source, is_anomaly AS p, label AS y FROM p LEFT JOIN l USING (event_id)),
c AS (SELECT window_start, source, count(*) AS n, count(y) AS n_labelled, count(*) FILTER (WHERE y AND p) AS tp,
             count(*) FILTER (WHERE NOT y AND p) AS fp, count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) FILTER (WHERE NOT y AND NOT p) AS tn
      FROM j GROUP BY 1, 2)
SELECT window_start, source, n, n_labelled, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
       round(coalesce((tp + tn) / nullif(n_labelled, 0), 0), 6) AS accuracy FROM c""")
def stream_accuracy(spark, sf):
    """Scored events meet labels that come up to two hours later (after one hour they no longer count; some never come)."""
    from tidemark.session import scratch_path
    from tidemark.streaming.accuracy import match_labels, windowed_accuracy
    from tidemark.streaming.scoring import BaselineModel, score_stream
    from tidemark.streaming.stats import read_stream
    ev = tb.readings(spark, sf).select("event_id", F.col("timestamp").cast("timestamp").alias("event_time"), "source", "value")
    i = F.col("event_id")
    minutes = (i * 7) % 120
    said = ev.where(i % 5 != 0).select(i, F.timestamp_micros(F.unix_micros("event_time") + minutes * 60_000_000).alias("label_time"),
                                       ((i % 7 == 0) | (F.col("value") > 200)).alias("label"))
    streams = []
    for name, rows, time in (("predictions", ev, "event_time"), ("labels", said, "label_time")):
        path = scratch_path(spark, name)
        rows.write.parquet(f"{path}/p0")
        _heartbeat(rows, time, "60 days").write.parquet(f"{path}/p1")
        streams.append(read_stream(spark, "parquet", f"{path}/p*", rows.schema))
    model = BaselineModel.fit(tb.readings(spark, sf), ["source"], "value", 3.0)
    matched = match_labels(score_stream(streams[0], model), streams[1])
    out = _run_to_table(spark, windowed_accuracy(matched), "accuracy").where("source IS NOT NULL")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "source", "n", "n_labelled",
                      *[r6(c).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


@register("stream_late_rows", """
WITH b AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS pos, count(*) OVER () AS n FROM events),
f AS (SELECT event_id, ts, CASE WHEN event_id % 10 = 0 THEN 4 ELSE CAST(floor((pos - 1) * 4 / n) AS BIGINT) END AS batch FROM b),
m AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 DAY AS watermark FROM f GROUP BY batch)
SELECT event_id, batch AS batch_id, coalesce(ts < watermark, false) AS late, CASE WHEN ts < watermark THEN watermark END AS watermark
FROM f JOIN m USING (batch)""")
def stream_late_rows(spark, sf):
    """Four time slices, then every tenth row a slice too late: rows more than a day behind come out in the late table."""
    from pyspark.sql import Window
    from tidemark.operators.rolling import positions
    from tidemark.session import scratch_path
    from tidemark.streaming.stats import read_stream
    from tidemark.streaming.timers import split_late
    ev = tb.readings(spark, sf).select("event_id", F.col("timestamp").cast("timestamp").alias("event_time"))
    n = ev.count()
    pos = positions(ev, [], ["event_time", "event_id"], n=n)
    batch = F.when(F.col("event_id") % 10 == 0, 4).otherwise(F.floor((F.col("_rn") - 1) * 4 / n)).cast("int")
    pos = pos.select("event_id", "event_time", batch.alias("b"))
    replay = scratch_path(spark, "events-late")
    for b in range(5):
        pos.where(F.col("b") == b).drop("b").coalesce(1).write.parquet(f"{replay}/p{b}")
    s = read_stream(spark, "parquet", f"{replay}/p*", ev.schema, max_files_per_trigger=1)
    good, late = scratch_path(spark, "on-time"), scratch_path(spark, "late")
    split_late(s, "event_time", "1 day", good, late, trigger={"availableNow": True}).awaitTermination()
    one = spark.read.parquet(good).select("event_id", "batch_id", F.lit(False).alias("late"), F.lit(None).cast("timestamp").alias("watermark"))
    two = spark.read.parquet(late).select("event_id", "batch_id", F.lit(True).alias("late"), "watermark")
    return one.unionByName(two).select("event_id", F.col("batch_id").cast("bigint").alias("batch_id"), "late",
                                       F.col("watermark").cast("timestamp_ntz").alias("watermark"))


@register("stream_zscore_microbatch",
          _zscore_sql("event_id, source, value", EVENTS_BY_TYPE_SQL, "source", "timestamp, event_id", "value"))
def stream_zscore_microbatch(spark, sf):
    """The rolling detector as one distributed batch job per micro-batch
    (state in versioned tables, hot keys chunked inside each micro-batch)."""
    from tidemark.session import scratch_path
    from tidemark.streaming.stats import write_time_ordered
    from tidemark.streaming.microbatch import start_rolling_detector
    replay = scratch_path(spark, "events-replay")
    write_time_ordered(tb.table(spark, sf, "events"), "ts", replay, 4)
    s = _events_stream(spark, sf, path=f"{replay}/part=*", max_files=1)
    sink = scratch_path(spark, "stream-zscore-mb")
    q = start_rolling_detector(s, ["source"], ["timestamp", "event_id"], "value", sink,
                               trigger={"availableNow": True}, method="zscore", window_size=100)
    q.awaitTermination()
    return spark.read.parquet(sink).select("event_id", "source", "value", *detection_cols())


def _baseline_scored_stream(spark, sf, **source):
    from tidemark.streaming.scoring import BaselineModel, score_stream
    model = BaselineModel.fit(tb.readings(spark, sf), ["source"], "value", 3.0)
    return score_stream(_events_stream(spark, sf, **source), model)


@register("stream_model_score", f"""
SELECT event_id, source, value, is_anomaly, round(anomaly_score, 6) AS anomaly_score FROM ({BASELINE_SQL}) s""")
def stream_model_score(spark, sf):
    out = _run_to_table(spark, _baseline_scored_stream(spark, sf), "stream-model-score")
    return out.select("event_id", "source", "value", "is_anomaly", r6("anomaly_score").alias("anomaly_score"))


@register("stream_counters", f"""
SELECT source, count(*) AS processed_count, count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
       round(count(*) FILTER (WHERE is_anomaly) / count(*), 6) AS anomaly_rate
FROM ({BASELINE_SQL}) s GROUP BY 1""")
def stream_counters(spark, sf):
    from tidemark.session import scratch_path
    from tidemark.streaming.scoring import latest_counters, start_counters
    from tidemark.streaming.stats import write_time_ordered
    replay, path = scratch_path(spark, "events-replay"), scratch_path(spark, "stream-counters")
    write_time_ordered(tb.table(spark, sf, "events"), "ts", replay, 4)
    scored = _baseline_scored_stream(spark, sf, path=f"{replay}/part=*", max_files=1)
    start_counters(scored, path, ["source"], trigger={"availableNow": True}).awaitTermination()
    out = latest_counters(spark, path, ["source"])
    return out.select("source", "processed_count", "anomaly_count", r6("anomaly_rate").alias("anomaly_rate"))


@register("stream_alerts", f"""
SELECT source, value, metric, strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, is_anomaly,
       round(anomaly_score, 6) AS anomaly_score, 'baseline_zscore' AS anomaly_type
FROM ({BASELINE_SQL}) s WHERE is_anomaly""")
def stream_alerts(spark, sf):
    from tidemark.session import scratch_path
    from tidemark.streaming.scoring import start_alerts
    a, qp = scratch_path(spark, "alerts"), scratch_path(spark, "alerts-quarantine")
    q = start_alerts(_baseline_scored_stream(spark, sf), a, qp, trigger={"availableNow": True})
    q.awaitTermination()
    out = spark.read.parquet(a)
    return out.select("source", "value", "metric", "timestamp", "is_anomaly", r6("anomaly_score").alias("anomaly_score"),
                      "anomaly_type")


@register("stream_ensemble", _default_ensemble_sql("z.event_id, z.source, z.value"))
def stream_ensemble(spark, sf):
    """The configured ensemble on a stream: stateful z-score, forest and LOF (fitted on the events
    table), weights 0.3 / 0.4 / 0.3."""
    from tidemark.session import scratch_path
    from tidemark.streaming.stats import write_time_ordered
    from tidemark.streaming.microbatch import start_rolling_detector
    members = _default_members(spark, sf)
    members.pop("statistical")
    replay = scratch_path(spark, "events-replay")
    write_time_ordered(tb.table(spark, sf, "events"), "ts", replay, 4)
    s = _events_stream(spark, sf, path=f"{replay}/part=*", max_files=1)
    sink = scratch_path(spark, "stream-ensemble")
    q = start_rolling_detector(s, ["source"], ["timestamp", "event_id"], "value", sink,
                               trigger={"availableNow": True}, method="zscore", window_size=100,
                               members=members, weights=DEFAULT_WEIGHTS, ensemble_threshold=0.5)
    q.awaitTermination()
    return _ensemble_columns(spark.read.parquet(sink), "event_id", "source", "value")


@register("stream_messages_end_to_end", f"""
SELECT source AS key, source, value, metric,
       is_anomaly, round(anomaly_score, 6) AS anomaly_score, 'baseline_zscore' AS anomaly_type
FROM ({BASELINE_SQL}) s""")
def stream_messages_end_to_end(spark, sf):
    """events -> JSON message files -> stream: decode, quarantine, score with a
    fitted baseline, envelope, keyed JSON sink; read back and unpacked."""
    from pyspark.sql import types as T
    from tidemark.session import scratch_path
    from tidemark.sources.decode import encode_json
    from tidemark.streaming.scoring import BaselineModel, score_messages
    ev = tb.readings(spark, sf)
    msgs_dir = scratch_path(spark, "messages")
    encode_json(ev.select("source", "value", "metric",
                          F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")), "source") \
        .select("value").write.text(msgs_dir)
    stream = spark.readStream.schema("value string").text(msgs_dir)
    model = BaselineModel.fit(ev, ["source"], "value", 3.0)
    sink, quarantine = scratch_path(spark, "messages-out"), scratch_path(spark, "messages-bad")
    q = score_messages(stream, model, sink, quarantine, trigger={"availableNow": True})
    q.awaitTermination()
    env = T.StructType([T.StructField("original_data", T.StructType([
        T.StructField("source", T.StringType()), T.StructField("value", T.DoubleType()),
        T.StructField("metric", T.StringType()), T.StructField("timestamp", T.StringType())])),
        T.StructField("is_anomaly", T.BooleanType()), T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("anomaly_type", T.StringType())])
    out = spark.read.schema("key string, value string").json(sink)
    body = F.from_json("value", env)
    return out.select("key", body["original_data"]["source"].alias("source"),
                      body["original_data"]["value"].alias("value"),
                      body["original_data"]["metric"].alias("metric"), body["is_anomaly"].alias("is_anomaly"),
                      r6(body["anomaly_score"]).alias("anomaly_score"), body["anomaly_type"].alias("anomaly_type"))


# ---------------------------------------------------------------- records broken by id, so that isolation, enforcement and defaults show


def _broken_messages(spark, sf):
    """The events as messages; some are no JSON, lack a field or carry a time that cannot be read."""
    i = F.col("event_id")

    def without(k, c):
        return F.when(i % k != 0, F.col(c)).alias(c)

    ev = tb.readings(spark, sf).withColumn("timestamp", F.when(i % 113 == 0, F.lit("at noon")).otherwise(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))
    body = F.to_json(F.struct(without(103, "source"), without(107, "value"), "metric", without(109, "timestamp")))
    return ev.select("event_id", F.when(i % 101 == 0, F.lit("{broken")).otherwise(body).alias("value"))


@register("quarantine_broken", """
SELECT CASE WHEN event_id % 101 = 0 THEN 'malformed_json' WHEN event_id % 103 = 0 THEN 'missing_source'
            WHEN event_id % 107 = 0 THEN 'missing_value' WHEN event_id % 109 = 0 OR event_id % 113 = 0 THEN 'missing_timestamp'
            ELSE 'ok' END AS status, event_id FROM events""")
def quarantine_broken(spark, sf):
    """Every message with the reason it is kept out for, or ok."""
    from tidemark.operators.quality import reading_reason, split_valid
    from tidemark.sources import decode as dc
    dec = dc.flatten(dc.decode_json(_broken_messages(spark, sf), "value", dc.READING, keep=("event_id",)))
    dec = dec.withColumn("timestamp", dc.parse_timestamp(F.col("timestamp")))
    good, bad = split_valid(dec, reading_reason())
    return (good.select(F.lit("ok").alias("status"), "event_id")
            .unionByName(bad.select(F.col("reason").alias("status"), "event_id")))


@register("default_timestamps", """
SELECT event_id, event_id % 109 = 0 AS filled, CASE WHEN event_id % 109 <> 0 AND event_id % 113 <> 0 THEN ts END AS timestamp
FROM events WHERE event_id % 101 <> 0""")
def default_timestamps(spark, sf):
    """Messages without a time get that of their arrival; a time that cannot be read is not one without."""
    from datetime import datetime, timezone
    from tidemark.sources import decode as dc
    began = F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S"))
    dec = dc.flatten(dc.decode_json(_broken_messages(spark, sf), "value", dc.READING, keep=("event_id",)))
    dec = dc.default_timestamp(dec.where("not _corrupt"))
    at = dc.parse_timestamp(F.col("timestamp"))
    filled = F.coalesce(at >= F.to_timestamp(began), F.lit(False))
    return dec.select("event_id", filled.alias("filled"), F.when(~filled, at).cast("timestamp_ntz").alias("timestamp"))


@register("schema_enforcement_broken", """
SELECT event_id, CASE WHEN event_id % 79 = 0 THEN 'missing_source' WHEN event_id % 97 = 0 THEN 'bad_value'
                      WHEN event_id % 83 = 0 THEN 'missing_timestamp' WHEN event_id % 89 = 0 THEN 'bad_is_anomaly' END AS reason,
       CASE WHEN event_id % 97 <> 0 THEN value END AS value, CASE WHEN event_id % 89 <> 0 THEN value > 100 END AS is_anomaly FROM events""")
def schema_enforcement_broken(spark, sf):
    """Text records typed by the alert schema: what is missing or does not cast makes a record invalid, for the first such field."""
    from pyspark.sql import types as T
    from tidemark.operators.quality import enforce_schema
    from tidemark.sources.decode import ALERT
    i = F.col("event_id")
    raw = tb.readings(spark, sf).select(
        i.cast("string").alias("event_id"), F.when(i % 79 != 0, F.col("source")).alias("source"),
        F.when(i % 97 == 0, F.lit("12,5")).otherwise(F.col("value").cast("string")).alias("value"), "metric",
        F.when(i % 83 != 0, F.col("timestamp").cast("string")).alias("timestamp"),
        F.when(i % 89 == 0, F.lit("maybe")).otherwise((F.col("value") > 100).cast("string")).alias("is_anomaly"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), *ALERT.fields])
    typed = enforce_schema(raw, schema, ["source", "value", "timestamp", "is_anomaly"])
    return typed.select("event_id", "reason", "value", "is_anomaly")


@register("merged_streams", """
SELECT event_id, event_type AS source, value, CASE WHEN user_id % 2 = 0 THEN 'even' END AS unit FROM events""")
def merged_streams(spark, sf):
    """Two streams of unlike columns as one: what one lacks is NULL there."""
    from tidemark.streaming.scoring import merge_streams
    even = tb.table(spark, sf, "events").select("event_id", (F.col("user_id") % 2 == 0).alias("even"))
    s = _events_stream(spark, sf).join(even, "event_id").select("event_id", "source", "value", "even")
    both = merge_streams(s.where("even").withColumn("unit", F.lit("even")), s.where("not even").drop("even")).drop("even")
    return _run_to_table(spark, both, "merged").select("event_id", "source", "value", "unit")


@register("retained_anomalies", f"""
SELECT event_id, timestamp, source, value FROM (
  SELECT * FROM (SELECT * FROM ({ZRES_SQL}) r WHERE is_anomaly ORDER BY timestamp DESC, event_id DESC LIMIT 200) k
  WHERE source = (SELECT min(event_type) FROM events)) s ORDER BY timestamp DESC, event_id DESC LIMIT 50""")
def retained_anomalies(spark, sf):
    """The newest 50 of one source among the 200 flagged rows that are retained."""
    from tidemark.operators import topk
    first = tb.readings(spark, sf).agg(F.min("source")).first()[0]
    out = topk.recent_anomalies(zscore_results(spark, sf), 50, source=first, retention=200)
    return out.select("event_id", "timestamp", "source", "value")


@register("unfitted_scores", """
SELECT detector, event_id, false AS is_anomaly, CAST(0.0 AS DOUBLE) AS anomaly_score, CASE WHEN detector IN ('statistical', 'ensemble') THEN detector ELSE 'unknown' END AS anomaly_type
FROM events, (SELECT unnest(['isolation_forest', 'lof', 'one_class_svm', 'statistical', 'ensemble']) AS detector) d""")
def unfitted_scores(spark, sf):
    """Every detector before its fit: all rows normal."""
    from tidemark.operators.ensemble import create_detector
    ev, out = tb.readings(spark, sf), None
    for name in ("isolation_forest", "lof", "one_class_svm", "statistical", "ensemble"):
        part = create_detector(name, {}, GLOBAL_EVENTS).unfitted().transform(ev).withColumn("detector", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.select("detector", "event_id", "is_anomaly", "anomaly_score", "anomaly_type")


@register("stream_processing_time", "SELECT event_id, true AS in_run FROM events")
def stream_processing_time(spark, sf):
    """Rows stamped with the time of their arrival instead of their own."""
    from datetime import datetime, timezone
    from tidemark.streaming.stats import event_time
    began = datetime.now(timezone.utc).timestamp()
    out = _run_to_table(spark, event_time(_events_stream(spark, sf), processing_time=True), "processing-time")
    at = F.col("event_time").cast("double")
    return out.select("event_id", ((at >= began - 1) & (at <= F.current_timestamp().cast("double"))).alias("in_run"))


@register("pipeline_latency", f"""
WITH r AS (SELECT z.event_id, z.timestamp, z.is_anomaly, (z.event_id * 13) % 50 / 10.0 AS lat, z.value > 150 AS label FROM ({ZRES_SQL}) z)
SELECT time_bucket(INTERVAL '1 day', timestamp) AS window_start, count(*) AS processed_count, round(avg(lat) + 0.000013, 4) AS latency_mean_s,
       round(avg(CASE WHEN label = is_anomaly THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM r GROUP BY 1""")
def pipeline_latency(spark, sf):
    """Latency between a reading's time and its processing, and accuracy against labels, per day."""
    from tidemark.operators import aggregates as ag
    us = F.unix_micros(F.col("timestamp").cast("timestamp")) + (F.col("event_id") * 13) % 50 * 100_000
    res = zscore_results(spark, sf).withColumns({"done_at": F.timestamp_micros(us), "label": F.col("value") > 150})
    out = ag.pipeline_metrics(res, duration="1 day", processing_col="done_at", label="label")
    return out.select("window_start", "processed_count", F.round(F.col("latency_mean_s") + 0.000013, 4).alias("latency_mean_s"), r6("accuracy").alias("accuracy"))
