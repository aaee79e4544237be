"""Timers, late rows, later labels and sketches."""
import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tidemark.operators import sketches, statistical as st
from tidemark.operators.alerts import with_empty_windows
from tidemark.operators.base import SeriesSpec
from tidemark.operators.drift import psi
from tidemark.sources import tables as tb
from tidemark.streaming import stats
from tidemark.streaming.timers import rolling_detector_event_time, silent_sources_stream, split_late

SPEC = SeriesSpec(("source",), ("event_time", "event_id"), "value")


def _events(spark, nan=True):
    value = F.when(F.col("event_id") % 31 == 0, F.lit(float("nan"))).when(F.col("event_id") % 37 == 0, F.lit(None)).otherwise(F.col("value"))
    return tb.readings(spark, SF001).select("event_id", F.col("timestamp").cast("timestamp").alias("event_time"), "source",
                                            (value if nan else F.col("value")).alias("value"))


def _heartbeat(spark, schema, at):
    return spark.createDataFrame([(None, at, None, None)], schema)


def _once(df, out, ck):
    df.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out).awaitTermination()


@pytest.mark.parametrize("method", ["zscore", "iqr"])
def test_timer_detector_scores_every_row_and_restarts(spark, method):
    base = tempfile.mkdtemp(prefix="tidemark-timer-")
    ev = _events(spark)
    parts = [ev.where(F.col("event_id") % 3 == k) for k in range(3)]
    parts[0].coalesce(1).write.parquet(os.path.join(base, "in", "p0"))
    s = stats.read_stream(spark, "parquet", os.path.join(base, "in", "*"), ev.schema, max_files_per_trigger=1)
    scored = rolling_detector_event_time(s, ["source"], "event_time", "event_id", "value", method, window_size=30, watermark="60 days")
    out, ck = os.path.join(base, "out"), os.path.join(base, "ck")
    _once(scored, out, ck)
    for k in (1, 2):  # more rows for a query that starts again from its checkpoint
        parts[k].coalesce(1).write.parquet(os.path.join(base, "in", f"p{k}"))
        _once(scored, out, ck)
    _heartbeat(spark, ev.schema, ev.agg(F.max("event_time") + F.expr("INTERVAL 90 DAYS")).first()[0]).write.parquet(os.path.join(base, "in", "p3"))
    _once(scored, out, ck)
    got = {r.event_id: r for r in spark.read.parquet(out).collect()}
    want = st.StatisticalDetector(SPEC, method, window_size=30).model().transform(ev).collect()
    assert len(got) == len(want) == 1000
    for r in want:
        g = got[r.event_id]
        assert (g.is_anomaly, g.anomaly_type) == (r.is_anomaly, r.anomaly_type) and abs(g.anomaly_score - r.anomaly_score) < 1e-9


def test_silent_source_is_told_without_input(spark):
    base = tempfile.mkdtemp(prefix="tidemark-silent-")
    schema = "source string, event_time timestamp"
    s = stats.read_stream(spark, "parquet", os.path.join(base, "in", "*"), spark.createDataFrame([], schema).schema, max_files_per_trigger=1)
    down = silent_sources_stream(s, ["source"], "event_time", "30 minutes", "1 minute")
    out, ck = os.path.join(base, "out"), os.path.join(base, "ck")

    def say(name, *rows):
        df = spark.createDataFrame([(a, f"2024-01-01 {t}") for a, t in rows], "source string, t string").select("source", F.col("t").cast("timestamp").alias("event_time"))
        df.coalesce(1).write.parquet(os.path.join(base, "in", name))
        _once(down, out, ck)
        return sorted((r.source, str(r.last_seen)[11:16]) for r in spark.read.parquet(out).collect())

    assert say("a", ("x", "10:00"), ("y", "10:00"), ("x", "10:20")) == []
    # y falls silent: the rows of x alone move the watermark on
    assert say("b", ("x", "10:45"), ("x", "10:40")) == [("y", "10:00")]
    assert say("c", ("y", "11:00"), ("x", "11:05")) == [("y", "10:00")]
    # a gap inside one micro-batch and an open one
    assert say("d", ("x", "12:00"), ("x", "12:10")) == [("x", "11:05"), ("y", "10:00"), ("y", "11:00")]


def test_split_late_keeps_every_row_across_restart(spark):
    base = tempfile.mkdtemp(prefix="tidemark-late2-")
    ev = _events(spark, nan=False)
    schema = ev.schema
    s = stats.read_stream(spark, "parquet", os.path.join(base, "in", "*"), schema, max_files_per_trigger=1)
    good, late, ck = (os.path.join(base, x) for x in ("good", "late", "ck"))
    cut = ev.agg(F.expr("percentile_approx(event_time, 0.5)")).first()[0]
    for name, part in (("a", ev.where(F.col("event_time") >= cut)), ("b", ev.where(F.col("event_time") < cut))):
        part.coalesce(1).write.parquet(os.path.join(base, "in", name))
        split_late(s, "event_time", "2 days", good, late, ck, {"availableNow": True}).awaitTermination()
    on_time, behind = spark.read.parquet(good), spark.read.parquet(late)
    mark = ev.agg(F.max("event_time") - F.expr("INTERVAL 2 DAYS")).first()[0]
    assert on_time.count() + behind.count() == 1000
    assert {r.event_id for r in behind.collect()} == {r.event_id for r in ev.where((F.col("event_time") < cut) & (F.col("event_time") < F.lit(mark))).collect()}
    assert behind.select("watermark").distinct().collect() == [(mark,)]


def test_microbatch_detector_ignores_nan_and_needs_its_state(spark):
    from tidemark.streaming.microbatch import start_rolling_detector
    base = tempfile.mkdtemp(prefix="tidemark-mbnan-")
    ev = _events(spark).withColumnRenamed("event_time", "timestamp")
    stats.write_time_ordered(ev, "timestamp", os.path.join(base, "in"), 3)
    s = stats.read_stream(spark, "parquet", os.path.join(base, "in", "part=*"), ev.schema, max_files_per_trigger=1)
    sink, ck = os.path.join(base, "out"), os.path.join(base, "ck")
    start = lambda **k: start_rolling_detector(s, ["source"], ["timestamp", "event_id"], "value", sink, checkpoint=ck,
                                               trigger={"availableNow": True}, window_size=30, **k)
    start().awaitTermination()
    want = {r.event_id: r for r in st.rolling_zscore(ev, SeriesSpec(("source",), ("timestamp", "event_id"), "value"), window_size=30).collect()}
    got = spark.read.parquet(sink).collect()
    assert len(got) == 1000
    assert all((r.is_anomaly, round(r.anomaly_score, 9)) == (want[r.event_id].is_anomaly, round(want[r.event_id].anomaly_score, 9)) for r in got)
    assert sorted(os.listdir(os.path.join(ck, "detector-state"))) == ["epoch=1", "epoch=2"]
    ev.limit(5).coalesce(1).write.parquet(os.path.join(base, "in", "part=00009"))
    with pytest.raises(Exception, match="does not belong"):
        start(state_path=os.path.join(base, "elsewhere")).awaitTermination()


def test_empty_windows_and_drift_of_missing_values(spark):
    m = spark.createDataFrame([("a", "2024-01-01 00:00", 3), ("b", "2024-01-01 03:00", 2), (None, "2024-01-01 01:00", 1)], "source string, t string, n int")
    m = m.select("source", F.col("t").cast("timestamp").alias("w"), "n")
    full = with_empty_windows(m, "w", "1 hour", ["source"], ["n"]).collect()
    assert len(full) == 12 and sum(r.n for r in full) == 6 and sum(r.n == 0 for r in full) == 9
    base = spark.createDataFrame([(float(i),) for i in range(100)] + [(float("nan"),), (None,)], "value double")
    shifted = spark.createDataFrame([(float(i + 60),) for i in range(100)], "value double")
    with_nulls = spark.createDataFrame([(float(i),) for i in range(100)] + [(None,)] * 50, "value double")
    assert psi(base, shifted).first().drift and not psi(base, with_nulls).first().drift
    assert abs(psi(base, with_nulls).first().psi) < 1e-9
    gone = psi(base.withColumn("k", F.lit(1)), spark.createDataFrame([(float("nan"), 1)], "value double, k int"), keys=["k"]).first()
    assert gone.drift and gone.cur_n == 0 and gone.cur_nulls == 1 and gone.base_nulls == 2


def test_merged_sketches_keep_their_rank_error(spark):
    rng = np.random.default_rng(0)
    vals = rng.lognormal(size=50_000)
    df = spark.createDataFrame([(int(i % 7), float(v)) for i, v in enumerate(vals)], "day int, value double").select(
        F.lit("s").alias("source"), F.timestamp_seconds(F.col("day") * 86400).alias("timestamp"), "value")
    base = sketches.merge_sketches(sketches.window_sketches(df, k=512), ["source"], k=512)
    q = base.select(F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / 10) for i in range(1, 10)])).alias("q")).first().q
    assert max(abs((vals <= x).mean() - i / 10) for i, x in enumerate(q, 1)) < 1.7 / 512 ** 0.9
    day = sketches.window_sketches(df.withColumn("value", F.col("value") * 3), k=512)
    out = sketches.quantile_drift(base, day).collect()
    assert len(out) == 7 and all(r.drift for r in out)
    assert not any(r.drift for r in sketches.quantile_drift(base, sketches.window_sketches(df, k=512)).collect())
    empty = sketches.window_sketches(df.withColumn("value", F.lit(float("nan"))))
    assert all(r.drift and r.psi is None and r.n == 0 and r.nulls > 0 for r in sketches.quantile_drift(base, empty).collect())


def test_one_class_svm_keeps_nu_with_an_outlier(spark):
    from tidemark.operators.ocsvm import OneClassSVMDetector
    vals = np.concatenate([np.random.default_rng(4).normal(50, 10, 1500), [1e7]])
    rows = [(i, float(v)) for i, v in enumerate(vals)] + [(9000, float("nan")), (9001, None), (9002, float("inf"))]
    df = spark.createDataFrame(rows, "id long, value double")
    spec = SeriesSpec((), ("id",), "value", "id")
    m = OneClassSVMDetector(spec, nu=0.1, max_iter=40).fit(df)
    flagged = {r.id for r in m.transform(df).where("is_anomaly").collect()}
    assert abs(len(flagged) / 1501 - 0.1) < 0.02 and not flagged & {9000, 9001}
    assert 1500 in flagged
    with pytest.raises(ValueError):
        OneClassSVMDetector(spec).fit(df.where("id > 8999 AND id < 9002"))


def test_long_history_is_kept_to_its_reach(spark):
    spec = SeriesSpec(("source",), ("event_time", "event_id"), "value")
    ev = _events(spark)
    cut = ev.agg(F.expr("percentile_approx(event_time, 0.8)")).first()[0]
    old, new = ev.where(F.col("event_time") < cut), ev.where(F.col("event_time") >= cut)
    for window in (20, 5):  # the gate of 10 reaches further than a window of 5
        model = st.StatisticalDetector(spec, window_size=window).fit(old)
        assert model.history.groupBy("source").count().agg(F.max("count")).first()[0] == max(window - 1, 10)
        whole = {r.event_id: r for r in st.rolling_zscore(ev, spec, window_size=window).collect()}
        for r in model.transform(new).collect():
            assert (r.is_anomaly, r.anomaly_type, round(r.anomaly_score, 9)) == (whole[r.event_id].is_anomaly, whole[r.event_id].anomaly_type,
                                                                                 round(whole[r.event_id].anomaly_score, 9))


class _Box(dict):
    """State variables of one key in memory, as value, list and map."""

    def getValueState(self, name, *schema):
        return self.setdefault(name, _Value())

    getListState = getMapState = getValueState

    def registerTimer(self, at):
        self["timers"] = self.get("timers", set()) | {at}

    def deleteTimer(self, at):
        self["timers"].discard(at)


class _Value:
    def __init__(self):
        self.v, self.rows, self.map = None, [], {}

    def get(self):
        return iter(self.rows) if self.rows else self.v

    def update(self, v):
        self.v = v

    def clear(self):
        self.v, self.rows = None, []

    def exists(self):
        return bool(self.rows) or self.v is not None

    def put(self, rows):
        self.rows = rows

    def appendList(self, rows):
        self.rows = self.rows + rows

    def appendValue(self, row):
        self.rows = self.rows + [row]

    def updateValue(self, k, v):
        self.map[k] = v

    def getValue(self, k):
        return self.map[k]

    def removeKey(self, k):
        del self.map[k]

    def keys(self):
        return iter(list(self.map))


class _At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _fire(processor, box, wm):
    out = []
    while min(box.get("timers") or {wm}) < wm:
        box["timers"].discard(min(box["timers"]))
        out += processor.handleExpiredTimer(("x",), _At(wm), None)
    return out


def test_due_rows_are_scored_part_by_part():
    from tidemark.streaming import timers
    from tidemark.streaming.stateful import _score
    n = 300_000
    rng = np.random.default_rng(3)
    rows = pd.DataFrame({"t": pd.to_datetime(rng.integers(0, n // 2, n) * 1000, unit="us"), "i": rng.integers(0, 50, n),
                         "value": rng.normal(size=n), "no": np.arange(n)})
    box, p = _Box(), timers._Rolling("t", "i", "value", list(rows.columns), "zscore", 3.0, 100, 10)
    p.init(box)
    out = []
    for a in range(0, n, 100_000):
        out += p.handleInputRows(("x",), (rows.iloc[b:b + 10_000] for b in range(a, a + 100_000, 10_000)), _At(0))
    for wm in (n // 6, n // 4, n):
        out += _fire(p, box, wm)
    assert max(map(len, out)) < 60_000
    got, want = pd.concat(out), rows.sort_values(["t", "i"], kind="stable")
    assert got["no"].tolist() == want["no"].tolist()
    flags, scores, _ = _score(want["value"].to_numpy(), 0, 0, 100, 3.0, 10, "zscore")
    assert np.array_equal(got["is_anomaly"], flags) and np.allclose(got["anomaly_score"], scores)


@pytest.mark.parametrize("seed", range(4))
def test_silences_are_told_from_spans(seed):
    from tidemark.streaming import timers
    rng = np.random.default_rng(seed)
    gap = 50_000
    t = np.unique(np.cumsum(rng.choice([1, 1000, 40_000, 50_000, 50_001, 90_000], 3000, p=[.5, .3, .1, .05, .04, .01])))
    box, p = _Box(), timers._Silence(["source"], "at_us", gap)
    p.init(box)
    told, left, wm = [], t + rng.integers(0, 400_000, len(t)), 0  # a row comes by its time of arrival
    for now in range(0, int(t[-1]) + 3_000_000, 150_000):
        new = t[(left >= now - 150_000) & (left < now)]
        frames = [pd.DataFrame({"at_us": rng.permutation(np.repeat(new, 2)).astype(float)})]
        list(p.handleInputRows(("x",), iter(frames), _At(wm)))
        wm = max(0, (now - 600_000) // 1000)
        told += [x for f in _fire(p, box, wm) for x in f["last_us"]]
        held = sum(len(v.rows) for v in box.values() if isinstance(v, _Value))
        assert held <= 2 + (np.diff(t) > gap).sum()
    assert told == [*t[:-1][np.diff(t) > gap], t[-1]]


def test_a_steady_source_is_held_as_one_span():
    from tidemark.streaming import timers
    box, p = _Box(), timers._Silence(["source"], "at_us", 5_000)
    p.init(box)
    list(p.handleInputRows(("x",), iter([pd.DataFrame({"at_us": np.arange(0, 10**7, 1000)})]), _At(0)))
    assert sum(len(v.rows) for v in box.values() if isinstance(v, _Value)) == 1
    assert _fire(p, box, 5_000) == []
    assert [x for f in _fire(p, box, 20_000) for x in f["last_us"]] == [10**7 - 1000]
