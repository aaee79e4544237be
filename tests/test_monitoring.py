from pyspark.sql import functions as F

from conftest import SF01
from tidemark.operators import aggregates as ag
from tidemark.operators import topk
from tidemark.operators.evaluate import classification_report, confusion_cells, unlabelled_metrics
from tidemark.operators.inject import inject_anomalies
from tidemark.operators.drift import psi
from tidemark.operators.alerts import evaluate_rules


def test_statistics_empty_and_rates(spark):
    empty = spark.createDataFrame([], "source string, is_anomaly boolean, timestamp timestamp")
    r = ag.processing_statistics(empty).first()
    assert (r.processed_count, r.anomaly_count, r.anomaly_rate, r.anomaly_rate_pct) == (0, 0, 0.0, 0.0)
    df = spark.createDataFrame([("a", True), ("a", False), ("b", None)], "source string, is_anomaly boolean")
    by = {x.source: x for x in ag.anomalies_by_source(df).collect()}
    assert by["a"].anomaly_rate == 0.5 and by["a"].anomaly_rate_pct == 50.0 and by["b"].anomaly_count == 0


def test_recent_limits(spark):
    df = spark.createDataFrame([(i, f"s{i % 2}", i % 3 == 0) for i in range(20)],
                               "event_id long, source string, is_anomaly boolean") \
        .withColumn("timestamp", F.col("event_id").cast("timestamp"))
    assert topk.recent_anomalies(df, 0).count() == 0  # limit 0 returns none
    last = [r.event_id for r in topk.recent_anomalies(df, 3).collect()]
    assert last == [18, 15, 12]
    per = topk.recent_per_source(df, 2)
    assert sorted((r.source, r.recency_rank, r.event_id) for r in per.collect()) == \
        [("s0", 1, 18), ("s0", 2, 12), ("s1", 1, 15), ("s1", 2, 9)]
    assert [r.event_id for r in topk.recent_anomalies(df, 5, source="s1").collect()] == [15, 9, 3]


def test_report_matches_definition(spark):
    rows = [(True, True)] * 3 + [(True, False)] * 1 + [(False, True)] * 2 + [(False, False)] * 14
    df = spark.createDataFrame(rows, "label boolean, is_anomaly boolean")
    r = classification_report(df, "label").first()
    tp, fn, fp, tn = 3, 1, 2, 14
    p1, r1, p0, r0 = tp / (tp + fp), tp / (tp + fn), tn / (tn + fn), tn / (tn + fp)
    f1 = lambda p, q: 2 * p * q / (p + q)
    s1, s0 = tp + fn, tn + fp
    assert abs(r.precision - (p0 * s0 + p1 * s1) / 20) < 1e-12
    assert abs(r.recall - (r0 * s0 + r1 * s1) / 20) < 1e-12
    assert abs(r.f1_score - (f1(p0, r0) * s0 + f1(p1, r1) * s1) / 20) < 1e-12
    assert r.confusion_matrix == [[14, 2], [1, 3]]
    cells = {(c.label, c.prediction): c["count"] for c in confusion_cells(df, "label").collect()}
    assert cells == {(False, False): 14, (False, True): 2, (True, False): 1, (True, True): 3}
    # no positives predicted and none true: zero division gives 0, accuracy 1
    z = classification_report(spark.createDataFrame([(False, False)] * 3, "label boolean, is_anomaly boolean"),
                              "label").first()
    assert z.accuracy == 1.0 and z.precision == 1.0
    u = unlabelled_metrics(spark.createDataFrame([(True, 1.0), (False, 0.0)], "is_anomaly boolean, anomaly_score double")).first()
    assert (u.anomaly_rate, u.avg_score, u.score_std) == (0.5, 0.5, 0.5)


def test_injection_rate_and_repeatability(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    a = inject_anomalies(ev, "event_id", "value", seed=42)
    b = inject_anomalies(ev.repartition(7), "event_id", "value", seed=42)
    share = a.where("is_anomaly").count() / 10000
    assert 0.04 < share < 0.06
    ka = sorted((r.event_id, r.value) for r in a.select("event_id", "value").collect())
    kb = sorted((r.event_id, r.value) for r in b.select("event_id", "value").collect())
    assert ka == kb
    kinds = {r.anomaly_kind for r in a.where("is_anomaly").collect()}
    assert kinds == {"spike", "drop", "drift"}
    assert a.where("is_anomaly and normal_value is null").count() == 0
    assert a.where("not is_anomaly and normal_value is not null").count() == 0


def test_psi_detects_shift(spark):
    base = spark.range(0, 5000).select((F.col("id") % 100).cast("double").alias("value"))
    same = spark.range(0, 5000).select(((F.col("id") * 7) % 100).cast("double").alias("value"))
    shifted = spark.range(0, 5000).select(((F.col("id") % 100) * 0.5 + 50).cast("double").alias("value"))
    assert psi(base, same).first().psi < 0.01
    r = psi(base, shifted).first()
    assert r.psi > 0.2 and r.drift


def test_rules_fire_on_their_metrics(spark):
    m = spark.createDataFrame([("a", 0.2, 1), ("b", 0.05, 0)], "source string, anomaly_rate double, service_health int")
    out = evaluate_rules(m, keep=["source"]).collect()
    assert [(r.rule, r.source) for r in out] == [("high_anomaly_rate", "a"), ("service_down", "b")]


def test_pipeline_metrics_latency_accuracy_and_errors(spark):
    rows = [(0, True, True, 2.0), (1, False, True, 4.0), (2, False, False, 6.0)]
    df = spark.createDataFrame(rows, "s long, is_anomaly boolean, label boolean, lat double") \
        .withColumn("timestamp", F.col("s").cast("timestamp")) \
        .withColumn("processed_at", (F.col("s") + F.col("lat")).cast("timestamp"))
    bad = df.limit(1).select("timestamp")
    m = ag.pipeline_metrics(df, bad, duration="1 hour", processing_col="processed_at", label="label").first()
    assert (m.processed_count, m.bad_count, m.anomaly_count) == (3, 1, 1)
    assert abs(m.accuracy - 2 / 3) < 1e-12 and abs(m.latency_mean_s - 4.0) < 1e-9
    assert abs(m.error_rate - 0.25) < 1e-12 and abs(m.rows_per_second - 3 / 3600) < 1e-12


def test_kafka_sink_options():
    from tidemark.streaming.stats import kafka_options, kafka_sink_options
    o = kafka_sink_options(["a:9092", "b:9092"], "anomaly-results")
    assert o["kafka.bootstrap.servers"] == "a:9092,b:9092" and o["kafka.acks"] == "all" and o["kafka.retries"] == "3"
    assert kafka_options(["a:9092"], "raw-data")["startingOffsets"] == "latest"


def test_bounded_retention(spark):
    df = spark.createDataFrame([(i, i % 2 == 0) for i in range(50)], "event_id long, is_anomaly boolean") \
        .withColumn("timestamp", F.col("event_id").cast("timestamp"))
    shown = [r.event_id for r in topk.bounded_retention(df, keep=10, show=3).collect()]
    assert shown == [48, 46, 44]
    assert topk.recent_anomalies(df, 1000).count() == 25


def test_per_source_within_retention(spark):
    # the last 4 anomalies overall are ids 18, 15, 12, 9 (sources s0, s1, s0, s1)
    df = spark.createDataFrame([(i, f"s{i % 2}", i % 3 == 0) for i in range(20)],
                               "event_id long, source string, is_anomaly boolean") \
        .withColumn("timestamp", F.col("event_id").cast("timestamp"))
    got = [r.event_id for r in topk.recent_anomalies(df, 50, source="s1", retention=4).collect()]
    assert got == [15, 9]
    per = topk.recent_per_source(df, 5, retention=4)
    assert sorted((r.source, r.event_id) for r in per.collect()) == [("s0", 12), ("s0", 18), ("s1", 9), ("s1", 15)]


def test_drift_reports_new_and_vanished_keys(spark):
    base = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("gone", 5.0)], "k string, value double")
    now = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("new", 5.0), (None, 1.0)], "k string, value double")
    got = {r.k: (r.base_n, r.cur_n, r.drift) for r in psi(base, now, keys=["k"]).collect()}
    assert got == {"a": (2, 2, False), "gone": (1, 0, True), "new": (0, 1, True), None: (0, 1, True)}


def test_a_rule_that_cannot_be_answered_is_an_error(spark):
    import pytest

    m = spark.createDataFrame([(0.5,)], "anomaly_rate double")
    with pytest.raises(ValueError, match="service_down"):
        evaluate_rules(m)


def test_a_source_that_stopped_is_reported(spark):
    import datetime as dt

    from tidemark.operators.alerts import silent_sources

    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("dead", t, 1), ("live", t, 2), ("live", t + dt.timedelta(minutes=170), 3)],
                               "source string, timestamp timestamp_ntz, event_id long")
    got = {(r.source, r.gap_minutes) for r in silent_sources(df, gap_minutes=60, as_of=t + dt.timedelta(minutes=180)).collect()}
    assert got == {("dead", 180.0), ("live", 170.0)}


def test_unlabelled_models_can_be_selected(spark):
    from tidemark.plans.training import RESULT_SCHEMA, auto_select

    names = [f.name for f in RESULT_SCHEMA.fields]
    rows = [tuple({"model_type": m, "trial_order": i, "error": e}.get(n) for n in names)
            for i, (m, e) in enumerate([("broken", "x"), ("lof", None), ("statistical", None)])]
    assert tuple(auto_select(spark.createDataFrame(rows, RESULT_SCHEMA)).first()) == ("lof", 0.0)
