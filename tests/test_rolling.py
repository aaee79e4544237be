import math

from pyspark.sql import functions as F

from conftest import SF01, rows
from tidemark.operators import statistical as st
from tidemark.operators.base import SeriesSpec
from tidemark.operators.rolling import over_series
from tidemark.plans.catalog import EVENTS_BY_TYPE, LINEITEM
from tidemark.sources import tables as tb


def _replay(values, window=100, thr=3.0, method="zscore", gate=10):
    """Independent list-based replay of the buffer detector."""
    import statistics
    buf, out = [], []
    for v in values:
        if len(buf) < gate:
            out.append((False, 0.0, "statistical"))
            buf.append(v)
            continue
        prev = buf[-(window - 1):]
        if method == "zscore":
            m = sum(prev) / len(prev)
            sd = math.sqrt(sum((x - m) ** 2 for x in prev) / len(prev))
            if sd == 0:
                out.append((False, 0.0, "zscore"))
            else:
                z = abs((v - m) / sd)
                out.append((z > thr, min(z / thr, 1.0), "zscore"))
        else:
            q = statistics.quantiles(prev, n=4, method="inclusive")
            q1, q3 = q[0], q[2]
            iqr = q3 - q1
            lo, hi = q1 - thr * iqr, q3 + thr * iqr
            if v < lo or v > hi:
                d = (lo - v) if v < lo else (v - hi)
                out.append((True, 1.0 if iqr == 0 else min(d / iqr / thr, 1.0), "iqr"))
            else:
                out.append((False, 0.0, "iqr"))
        buf.append(v)
    return out


def test_flagship_count(spark):
    out = st.rolling_zscore(tb.readings(spark, SF01), EVENTS_BY_TYPE)
    assert out.where("is_anomaly").count() == 217
    assert out.count() == 10000


def test_hot_key_path_equals_plain(spark):
    df = tb.readings(spark, SF01)
    plain = st.rolling_zscore(df, EVENTS_BY_TYPE, hot_key_rows=None)
    hot = st.rolling_zscore(df, EVENTS_BY_TYPE, hot_key_rows=500, chunk_rows=300)
    a = rows(plain, "event_id", "is_anomaly", "anomaly_score", "anomaly_type")
    b = rows(hot, "event_id", "is_anomaly", "anomaly_score", "anomaly_type")
    assert len(a) == len(b) == 10000
    for x, y in zip(a, b):
        assert x[0] == y[0] and x[1] == y[1] and x[3] == y[3]
        assert abs(x[2] - y[2]) < 1e-9


def test_hot_key_iqr_lineitem_equals_plain(spark):
    df = tb.lineitem_series(spark, SF01)
    plain = st.rolling_iqr(df, LINEITEM, hot_key_rows=None)
    hot = st.rolling_iqr(df, LINEITEM, hot_key_rows=300, chunk_rows=250)
    k = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "is_anomaly", "anomaly_score")
    assert rows(plain, *k) == rows(hot, *k)


def test_mixed_hot_and_cold_keys(spark):
    # one hot key ('click' made to hold most rows) next to cold ones
    df = tb.readings(spark, SF01).withColumn(
        "source", F.when(F.col("event_id") % 10 < 7, F.lit("hot")).otherwise(F.col("source")))
    plain = st.rolling_zscore(df, EVENTS_BY_TYPE, hot_key_rows=None)
    hot = st.rolling_zscore(df, EVENTS_BY_TYPE, hot_key_rows=2000, chunk_rows=700)
    k = ("event_id", "is_anomaly", "anomaly_type")
    assert rows(plain, *k) == rows(hot, *k)


def test_replay_matches_window(spark):
    import random
    rnd = random.Random(7)
    vals = [rnd.gauss(50, 10) for _ in range(300)] + [5.0] * 30 + [rnd.gauss(50, 10) for _ in range(40)]
    vals[150] = 500.0
    pdf = [(i, float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(pdf, "event_id long, value double").withColumn("source", F.lit("s"))
    from tidemark.operators.base import SeriesSpec
    spec = SeriesSpec(("source",), ("event_id",), "value")
    for method in ("zscore", "iqr"):
        for w in (10, 100):
            fn = st.rolling_zscore if method == "zscore" else st.rolling_iqr
            got = fn(df, spec, window_size=w).orderBy("event_id").collect()
            exp = _replay(vals, window=w, method=method)
            for r, e in zip(got, exp):
                assert r["is_anomaly"] == e[0], (method, w, r)
                assert abs(r["anomaly_score"] - e[1]) < 1e-9
                assert r["anomaly_type"] == e[2]


def test_seeded_history(spark):
    from tidemark.operators.base import SeriesSpec
    spec = SeriesSpec(("source",), ("event_id",), "value")
    hist = spark.createDataFrame([(i, 50.0 + (i % 5)) for i in range(20)], "event_id long, value double") \
        .withColumn("source", F.lit("s"))
    new = spark.createDataFrame([(100, 52.0), (101, 500.0)], "event_id long, value double") \
        .withColumn("source", F.lit("s"))
    out = st.StatisticalDetector(spec).fit(hist).transform(new).orderBy("event_id").collect()
    assert [r["is_anomaly"] for r in out] == [False, True]
    assert out[0]["anomaly_type"] == "zscore"


def test_constant_series_and_short(spark):
    from tidemark.operators.base import SeriesSpec
    spec = SeriesSpec(("source",), ("event_id",), "value")
    df = spark.createDataFrame([(i, 7.0) for i in range(12)], "event_id long, value double") \
        .withColumn("source", F.lit("s"))
    z = st.rolling_zscore(df, spec).orderBy("event_id").collect()
    assert [r["anomaly_type"] for r in z] == ["statistical"] * 10 + ["zscore"] * 2
    assert all(r["anomaly_score"] == 0.0 and not r["is_anomaly"] for r in z)
    df2 = df.union(spark.createDataFrame([(12, 9.0)], "event_id long, value double")
                   .withColumn("source", F.lit("s")))
    q = st.rolling_iqr(df2, spec).orderBy("event_id").collect()
    assert q[-1]["is_anomaly"] and q[-1]["anomaly_score"] == 1.0  # iqr 0


def test_over_series_halo_after(spark):
    # a following frame (needed by neighbour methods) also survives chunking
    df = tb.readings(spark, SF01)

    def cols(w):
        return {"nxt": F.sum("value").over(w.rowsBetween(1, 3)), "prv": F.sum("value").over(w.rowsBetween(-3, -1))}
    a = over_series(df, ["source"], ["timestamp", "event_id"], cols, 3, 3, hot_key_rows=None)
    b = over_series(df, ["source"], ["timestamp", "event_id"], cols, 3, 3, hot_key_rows=100, chunk_rows=64)
    ka = rows(a.select("event_id", F.round("nxt", 6).alias("n"), F.round("prv", 6).alias("p"), "_rn"))
    kb = rows(b.select("event_id", F.round("nxt", 6).alias("n"), F.round("prv", 6).alias("p"), "_rn"))
    assert ka == kb


def test_global_series_chunked_equals_plain(spark):
    from tidemark.operators.base import SeriesSpec
    df = tb.readings(spark, SF01)
    spec = SeriesSpec((), ("timestamp", "event_id"), "value")
    a = st.rolling_zscore(df, spec, hot_key_rows=None)
    b = st.rolling_zscore(df, spec, hot_key_rows=1000, chunk_rows=900)
    k = ("event_id", "is_anomaly", "anomaly_type")
    assert rows(a, *k) == rows(b, *k)


def test_null_key_hot_and_cold(spark):
    # a NULL key is a series too, also when it is hot
    df = tb.readings(spark, SF01).withColumn(
        "source", F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("source")))
    plain = st.rolling_zscore(df, EVENTS_BY_TYPE, hot_key_rows=None)
    hot = st.rolling_zscore(df, EVENTS_BY_TYPE, hot_key_rows=1500, chunk_rows=600)
    k = ("event_id", "is_anomaly", "anomaly_type")
    a, b = rows(plain, *k), rows(hot, *k)
    assert len(b) == 10000 and a == b
    assert plain.where(F.col("source").isNull()).count() == 3334


def test_null_nan_and_constant_values_score_nothing(spark):
    """NULL and NaN are no readings, for batch and buffer alike; a constant frame has no spread."""
    import numpy as np

    from tidemark.streaming.scoring import BaselineModel
    from tidemark.streaming.stateful import _score

    vals = [float(i % 7) for i in range(20)] + [None, float("nan"), 100.0, None, 3.0] + [0.1] * 60
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(vals)], "source string, t long, value double")
    spec = SeriesSpec(keys=("source",), order=("t",), value="value", id="t")
    for method in ("zscore", "iqr"):
        batch = {r.t: r for r in st.StatisticalDetector(spec, method, window_size=30).model().transform(df).collect()}
        arr = np.array([np.nan if v is None else v for v in vals])
        flags, scores, _ = _score(arr, 0, 0, 30, 3.0, 10, method)
        for t in batch:
            assert batch[t].is_anomaly == flags[t], (method, t)
            assert np.isclose(batch[t].anomaly_score, scores[t]), (method, t)
        assert [batch[t].anomaly_score for t in (20, 21, 23)] == [0.0] * 3
        assert batch[22].is_anomaly
        if method == "zscore":
            assert batch[84].anomaly_score == 0.0
    base = {r.t: r.anomaly_score for r in BaselineModel.fit(df).transform(df).collect()}
    assert base[20] == base[21] == 0.0 and base[22] > 0
