"""Plan-shape checks: pushdown, pruning, one exchange per window, no Python in scoring."""
from pyspark.sql import functions as F

from conftest import SF01
from tidemark.operators import statistical as st
from tidemark.operators import topk
from tidemark.plans.catalog import EVENTS_BY_TYPE
from tidemark.sources import tables as tb
from tidemark.sources.sinks import envelope


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_source_filter_reaches_scan_through_window(spark):
    out = st.rolling_zscore(tb.readings(spark, SF01), EVENTS_BY_TYPE).where(F.col("source") == "click")
    p = _plan(out)
    assert "EqualTo(event_type,click)" in p
    assert out.count() == 2006


def test_projection_pruned(spark):
    out = st.rolling_zscore(tb.readings(spark, SF01), EVENTS_BY_TYPE).select("event_id", "is_anomaly")
    p = _plan(out)
    assert "props" not in p and "user_id" not in p


def test_single_exchange_for_zscore_and_iqr(spark):
    from tidemark.operators.ensemble import EnsembleModel
    from tidemark.operators.statistical import StatisticalDetector
    m = EnsembleModel({"z": StatisticalDetector(EVENTS_BY_TYPE).model(),
                       "q": StatisticalDetector(EVENTS_BY_TYPE, "iqr").model()}, {}, 0.5, False)
    p = _plan(m.transform(tb.readings(spark, SF01)))
    assert p.count("Exchange hashpartitioning") == 1
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_recent_is_top_k(spark):
    res = st.rolling_zscore(tb.readings(spark, SF01), EVENTS_BY_TYPE)
    assert "TakeOrderedAndProject" in _plan(topk.recent_anomalies(res, 10))
    p = _plan(topk.recent_per_source(res, 5))
    assert "WindowGroupLimit" in p


def test_envelope_and_filters(spark):
    res = st.rolling_zscore(tb.readings(spark, SF01), EVENTS_BY_TYPE)
    env = envelope(res, ["event_id", "timestamp", "source", "metric", "value"], ["value"])
    r = env.where("is_anomaly").first()
    assert r.original_data.event_id is not None and r.transformed_data.value == r.original_data.value
    assert r.processing_timestamp is not None and r.source == r.original_data.source
    flagged = res.where("is_anomaly")
    assert flagged.count() == 217
    assert flagged.where(F.col("source") == "view").count() == \
        res.where((F.col("source") == "view") & F.col("is_anomaly")).count()


def test_release_scratch(spark):
    import os
    from tidemark.session import materialize, release_scratch
    t = materialize(spark.range(10), "tmp-test")
    assert t.count() == 10
    path = t.inputFiles()[0].replace("file:", "")
    assert os.path.exists(path)
    assert release_scratch(spark) >= 1
    assert not os.path.exists(path)
