import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001, rows
from tidemark.operators.base import SeriesSpec
from tidemark.operators import statistical as st
from tidemark.sources import tables as tb
from tidemark.streaming import stats
from tidemark.streaming.stateful import rolling_detector_stream


def _replay(spark, sf, slices):
    base = tempfile.mkdtemp(prefix="tidemark-stream-")
    stats.write_time_ordered(tb.table(spark, sf, "events"), "ts", os.path.join(base, "in"), slices)
    schema = tb.table(spark, sf, "events").schema
    s = stats.read_stream(spark, "parquet", os.path.join(base, "in", "part=*"), schema, max_files_per_trigger=1)
    s = s.select("event_id", F.col("ts").alias("timestamp"), F.col("event_type").alias("source"), "value")
    return base, s


def _run(df, base, name, mode="append"):
    out, ck = os.path.join(base, name), os.path.join(base, name + "-ck")
    q = (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", ck)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    return q, out


def test_stateful_stream_equals_batch_iqr(spark):
    base, s = _replay(spark, SF001, 3)
    scored = rolling_detector_stream(s, ["source"], ["timestamp", "event_id"], "value", "iqr", 3.0, 30, 10)
    _, out = _run(scored, base, "iqr")
    got = spark.read.parquet(out)
    spec = SeriesSpec(("source",), ("timestamp", "event_id"), "value")
    exp = st.rolling_iqr(tb.readings(spark, SF001).drop("metric", "user_id"), spec, window_size=30)
    k = ("event_id", "is_anomaly", "anomaly_type")
    assert rows(got, *k) == rows(exp, *k)
    a = {r.event_id: r.anomaly_score for r in got.collect()}
    b = {r.event_id: r.anomaly_score for r in exp.collect()}
    assert all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_stream_restart_from_checkpoint(spark):
    # a stopped query resumes from its checkpoint: state survives, no row is scored twice
    base, s = _replay(spark, SF001, 4)
    scored = rolling_detector_stream(s, ["source"], ["timestamp", "event_id"], "value", "zscore", 3.0, 100, 10)
    out, ck = os.path.join(base, "z"), os.path.join(base, "z-ck")
    q = (scored.writeStream.format("parquet").option("checkpointLocation", ck)
         .trigger(processingTime="0 seconds").start(out))
    q.processAllAvailable()
    q.stop()
    # more data arrives as new files; the restarted query continues from the state
    q2 = (scored.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q2.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 1000 and got.select("event_id").distinct().count() == 1000
    spec = SeriesSpec(("source",), ("timestamp", "event_id"), "value")
    exp = st.rolling_zscore(tb.readings(spark, SF001), spec)
    k = ("event_id", "is_anomaly", "anomaly_type")
    assert rows(got, *k) == rows(exp, *k)


def test_watermark_drops_late_rows(spark):
    base = tempfile.mkdtemp(prefix="tidemark-late-")
    ev = tb.readings(spark, SF001).select("source", "value", F.col("timestamp").cast("timestamp").alias("event_time"))
    # file 1: the second half in time; file 2: rows 10 days older -> late
    cut = ev.agg(F.expr("percentile_approx(event_time, 0.5)")).first()[0]
    ev.where(F.col("event_time") >= cut).coalesce(1).write.parquet(os.path.join(base, "in", "a"))
    schema = ev.schema
    s = stats.read_stream(spark, "parquet", os.path.join(base, "in", "*"), schema, max_files_per_trigger=1)
    ws = stats.window_stats(s, "event_time", "1 hour", "30 seconds", ["source"])
    out, ck = os.path.join(base, "out"), os.path.join(base, "ck")
    q = ws.writeStream.format("parquet").option("checkpointLocation", ck).trigger(processingTime="0 seconds").start(out)
    q.processAllAvailable()
    ev.where(F.col("event_time") < cut).coalesce(1).write.parquet(os.path.join(base, "in", "b"))
    q.processAllAvailable()
    dropped = sum(stats.dropped_by_watermark(type("Q", (), {"lastProgress": p})()) for p in q.recentProgress)
    q.stop()
    assert dropped > 0
    # every emitted window is built from on-time rows only
    emitted = spark.read.parquet(out)
    assert emitted.where(F.col("window_end") <= F.lit(cut)).count() == 0


def test_stream_union_and_deploy_forest(spark):
    from tidemark.operators.isolation_forest import IsolationForestDetector
    from tidemark.plans import registry
    from tidemark.streaming.scoring import deploy, merge_streams
    base, s = _replay(spark, SF001, 2)
    root = os.path.join(base, "registry")
    spec = SeriesSpec((), ("timestamp", "event_id"), "value", "event_id")
    model = IsolationForestDetector(spec, n_estimators=20).fit(tb.readings(spark, SF001))
    registry.save_model(spark, model, root, "forest")
    both = merge_streams(s, s.withColumn("source", F.concat(F.lit("copy_"), "source")))
    scored = deploy(spark, root, "forest", both)
    _, out = _run(scored, base, "deployed")
    got = spark.read.parquet(out)
    assert got.count() == 2000
    batch = model.transform(tb.readings(spark, SF001))
    a = {r.event_id: r.anomaly_score for r in got.where(~F.col("source").startswith("copy_")).collect()}
    b = {r.event_id: r.anomaly_score for r in batch.collect()}
    assert a == b


def test_event_time_buffering_equals_batch_out_of_order(spark):
    # rows arrive out of time order within the watermark delay; the buffered
    # detector still reproduces the batch scores for every row it emits
    from tidemark.streaming.stateful import rolling_detector_event_time
    base = tempfile.mkdtemp(prefix="tidemark-eto-")
    ev = tb.readings(spark, SF001).select("event_id", F.col("timestamp").cast("timestamp").alias("event_time"),
                                           "source", "value")
    # 4 files: by time slice, but inside each slice odd and even ids arrive separately (odd first)
    lo, hi = ev.agg(F.min("event_time").cast("double"), F.max("event_time").cast("double")).first()
    step = (hi - lo) / 2
    i = 0
    for k in range(2):
        sl = ev.where((F.col("event_time").cast("double") >= lo + k * step) &
                      ((F.col("event_time").cast("double") < lo + (k + 1) * step) if k < 1 else F.lit(True)))
        for par in (1, 0):
            sl.where(F.col("event_id") % 2 == par).coalesce(1).write.parquet(os.path.join(base, "in", f"p{i}"))
            i += 1
    s = stats.read_stream(spark, "parquet", os.path.join(base, "in", "*"), ev.schema, max_files_per_trigger=1)
    scored = rolling_detector_event_time(s, ["source"], "event_time", "event_id", "value", "zscore",
                                         watermark="7 days")
    _, out = _run(scored, base, "eto")
    got = spark.read.parquet(out)
    spec = SeriesSpec(("source",), ("event_time", "event_id"), "value")
    exp = {r.event_id: r for r in st.rolling_zscore(ev, spec).collect()}
    g = got.collect()
    assert len(g) > 300  # rows older than the final watermark are emitted
    for r in g:
        e = exp[r.event_id]
        assert (r.is_anomaly, r.anomaly_type) == (e.is_anomaly, e.anomaly_type)
        assert abs(r.anomaly_score - e.anomaly_score) < 1e-9


def test_processing_time_console_and_report(spark):
    from tidemark.sources.sinks import start_console, write_report
    base, s = _replay(spark, SF001, 1)
    stamped = stats.event_time(s, processing_time=True)
    assert dict(stamped.dtypes)["event_time"] == "timestamp"
    q = start_console(stamped.where("value < 0"), checkpoint=os.path.join(base, "c"))
    q.processAllAvailable()
    q.stop()
    rep = spark.createDataFrame([("statistical", 0.9)], "model_type string, f1_score double")
    write_report(rep, os.path.join(base, "report"))
    assert spark.read.json(os.path.join(base, "report")).first().model_type == "statistical"


def test_vectorised_scorer_equals_list_replay():
    import random
    import numpy as np
    from test_rolling import _replay
    from tidemark.streaming.stateful import _score
    rnd = random.Random(5)
    vals = [rnd.gauss(50, 10) for _ in range(260)] + [5.0] * 40 + [rnd.gauss(50, 10) for _ in range(50)]
    vals[120] = 400.0
    for method in ("zscore", "iqr"):
        for w in (10, 100):
            exp = _replay(vals, window=w, method=method)
            # all at once, and split into a state part + a batch part
            for start in (0, 137):
                arr = np.array(vals, dtype=float)
                f, s, k = _score(arr, start, start, w, 3.0, 10, method, block=64)
                for i, e in enumerate(exp[start:]):
                    assert (bool(f[i]), k[i]) == (e[0], e[2]), (method, w, start, i)
                    assert abs(s[i] - e[1]) < 1e-9


def test_microbatch_detector_equals_batch_with_hot_keys(spark):
    # every key is "hot" (tiny threshold): each micro-batch is scored with the
    # chunked window path; results equal the single batch window
    from tidemark.streaming.microbatch import start_rolling_detector
    base, s = _replay(spark, SF001, 4)
    for method in ("zscore", "iqr"):
        sink = os.path.join(base, f"mb-{method}")
        q = start_rolling_detector(s, ["source"], ["timestamp", "event_id"], "value", sink,
                                   checkpoint=os.path.join(base, f"mb-ck-{method}"), trigger={"availableNow": True},
                                   method=method, window_size=30, hot_key_rows=20, chunk_rows=40)
        q.awaitTermination()
        got = spark.read.parquet(sink)
        assert got.select("batch_id").distinct().count() == 4
        spec = SeriesSpec(("source",), ("timestamp", "event_id"), "value")
        fn = st.rolling_zscore if method == "zscore" else st.rolling_iqr
        exp = {r.event_id: r for r in fn(tb.readings(spark, SF001), spec, window_size=30).collect()}
        g = got.collect()
        assert len(g) == 1000
        for r in g:
            e = exp[r.event_id]
            assert (r.is_anomaly, r.anomaly_type) == (e.is_anomaly, e.anomaly_type), (method, r.event_id)
            assert abs(r.anomaly_score - e.anomaly_score) < 1e-9


def test_microbatch_detector_null_key(spark):
    from tidemark.streaming.microbatch import start_rolling_detector
    base = tempfile.mkdtemp(prefix="tidemark-mbnull-")
    ev = tb.readings(spark, SF001).select("event_id", "timestamp", "value", F.when(
        F.col("event_id") % 2 == 0, F.lit(None).cast("string")).otherwise(F.col("source")).alias("source"))
    stats.write_time_ordered(ev, "timestamp", os.path.join(base, "in"), 3)
    s = stats.read_stream(spark, "parquet", os.path.join(base, "in", "part=*"), ev.schema, max_files_per_trigger=1)
    sink = os.path.join(base, "out")
    q = start_rolling_detector(s, ["source"], ["timestamp", "event_id"], "value", sink,
                               checkpoint=os.path.join(base, "ck"), trigger={"availableNow": True}, window_size=30)
    q.awaitTermination()
    got = spark.read.parquet(sink)
    spec = SeriesSpec(("source",), ("timestamp", "event_id"), "value")
    exp = st.rolling_zscore(ev, spec, window_size=30)
    k = ("event_id", "is_anomaly", "anomaly_type")
    assert got.count() == 1000 and rows(got, *k) == rows(exp, *k)
