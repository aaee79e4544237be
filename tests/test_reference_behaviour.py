"""The original unit tests' intent, restated for DataFrame detectors."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.base import SeriesSpec
from tidemark.operators.ensemble import EnsembleDetector, create_detector, flatten_config
from tidemark.operators.isolation_forest import IsolationForestDetector
from tidemark.operators.lof import LOFDetector
from tidemark.operators.ocsvm import OneClassSVMDetector
from tidemark.operators.statistical import StatisticalDetector
from tidemark.sources.inputs import as_frame

SPEC = SeriesSpec((), ("id",), "value", "id")


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.RandomState(42)
    normal = rng.normal(50, 10, 100)
    anomalous = rng.normal(100, 5, 20)
    return normal, anomalous


def _df(spark, vals, start=0):
    return spark.createDataFrame([(start + i, float(v)) for i, v in enumerate(vals)], "id long, value double")


def test_isolation_forest_config_and_result(spark, series):
    normal, _ = series
    d = IsolationForestDetector(SPEC, contamination=0.1, n_estimators=50)
    assert d.contamination == 0.1 and d.n_estimators == 50
    m = d.fit(_df(spark, normal))
    r = m.transform(_df(spark, [50.0], 1000)).first()
    assert set(["is_anomaly", "anomaly_score", "anomaly_type"]) <= set(r.asDict())
    assert r["anomaly_type"] == "isolation_forest"
    r2 = m.transform(_df(spark, [100.0], 2000)).first()
    assert r2["is_anomaly"]


def test_unfitted_defaults(spark):
    df = _df(spark, [50.0])
    for d, kind in ((IsolationForestDetector(SPEC), "unknown"), (LOFDetector(SPEC), "unknown"),
                    (OneClassSVMDetector(SPEC), "unknown"), (StatisticalDetector(SPEC), "statistical"),
                    (EnsembleDetector(SPEC), "ensemble")):
        r = d.unfitted().transform(df).first()
        assert (r["is_anomaly"], r["anomaly_score"], r["anomaly_type"]) == (False, 0.0, kind)


def test_statistical_defaults_and_history(spark, series):
    normal, _ = series
    d = StatisticalDetector(SPEC)
    assert (d.method, d.threshold, d.window_size) == ("zscore", 3.0, 100)
    m = d.fit(_df(spark, normal))
    r = m.transform(_df(spark, [50.0, 100.0], 1000)).orderBy("id").collect()
    assert r[0]["anomaly_type"] == "zscore" and not r[0]["is_anomaly"]
    assert r[1]["is_anomaly"]
    r = StatisticalDetector(SPEC, method="iqr").fit(_df(spark, normal)).transform(_df(spark, [50.0], 1000)).first()
    assert r["anomaly_type"] == "iqr"


def test_buffer_bounded_after_many_values(spark, series):
    # after 100 fitted values and 150 more, statistics use only the last 99 values
    normal, _ = series
    new = [float(i) for i in range(150)]
    out = StatisticalDetector(SPEC).fit(_df(spark, normal)).transform(_df(spark, new, 1000))
    last = out.orderBy(F.col("id").desc()).first()
    prev = np.array(new[-100:-1])
    z = abs((149.0 - prev.mean()) / prev.std())
    assert abs(last["anomaly_score"] - min(z / 3.0, 1.0)) < 1e-12


def test_ensemble_members_and_results(spark, series):
    normal, _ = series
    cfg = {"detectors": {"isolation_forest": {"contamination": 0.1, "n_estimators": 20},
                         "statistical": {"method": "zscore", "threshold": 3.0}},
           "weights": {"isolation_forest": 0.6, "statistical": 0.4}, "threshold": 0.5}
    d = create_detector("ensemble", cfg, SPEC)
    assert set(d.detectors) == {"isolation_forest", "statistical"}
    m = d.fit(_df(spark, normal))
    r = m.transform(_df(spark, [50.0, 100.0], 1000)).orderBy("id").collect()
    assert set(r[0]["detector_results"]) == {"isolation_forest", "statistical"}
    assert r[0]["anomaly_type"] == "ensemble"
    assert not r[0]["is_anomaly"] and r[1]["is_anomaly"]
    s = r[1]["detector_results"]
    exp = (0.6 * s["isolation_forest"]["score"] + 0.4 * s["statistical"]["score"])
    assert abs(r[1]["anomaly_score"] - exp) < 1e-12
    # the original score scale makes the same ensemble flag everything
    dc = EnsembleDetector(SPEC, **cfg, compat_scores=True).fit(_df(spark, normal))
    assert dc.transform(_df(spark, [50.0], 1000)).first()["is_anomaly"]


def test_factory(spark):
    for t, cls in (("isolation_forest", IsolationForestDetector), ("lof", LOFDetector),
                   ("one_class_svm", OneClassSVMDetector), ("statistical", StatisticalDetector),
                   ("ensemble", EnsembleDetector)):
        assert isinstance(create_detector(t, {}, SPEC), cls)
    with pytest.raises(ValueError, match="Unknown detector type"):
        create_detector("bogus", {})


def test_flatten_config():
    cfg = {"anomaly_detection": {"detectors": {"isolation_forest": {"contamination": 0.1},
                                               "one_class_svm": {"nu": 0.1},
                                               "statistical": {"method": "zscore"}},
                                 "ensemble": {"weights": {"isolation_forest": 0.4}, "threshold": 0.5}}}
    f = flatten_config(cfg)
    assert f["ensemble"]["weights"] == {"isolation_forest": 0.4}
    assert set(f["ensemble"]["detectors"]) == {"isolation_forest", "statistical"}


def test_data_preparation(spark):
    assert [r.value for r in as_frame(spark, {"value": 50.0}).collect()] == [50.0]
    assert [r.value for r in as_frame(spark, {"data": 7}).collect()] == [7.0]
    assert [r.value for r in as_frame(spark, {}).collect()] == [0.0]
    assert as_frame(spark, [1.0, 2.0, 3.0]).count() == 3
    assert as_frame(spark, np.array([1.0, 2.0, 3.0])).count() == 3
    assert as_frame(spark, np.array([[1.0], [2.0]])).count() == 2
    assert [r.value for r in as_frame(spark, 50.0).collect()] == [50.0]


def test_one_class_svm_properties(spark):
    rng = np.random.default_rng(42)
    df = _df(spark, rng.normal(50, 10, 2000))
    m = OneClassSVMDetector(SPEC, nu=0.1, max_iter=25).fit(df)
    share = m.transform(df).where("is_anomaly").count() / 2000
    assert abs(share - 0.1) <= 0.02
    r = {x["value"]: x for x in m.transform(_df(spark, [50.0, 100.0, 0.0, 150.0], 9000)).collect()}
    assert not r[50.0]["is_anomaly"]
    assert r[100.0]["is_anomaly"] and r[0.0]["is_anomaly"] and r[150.0]["is_anomaly"]
    assert all(0.0 <= x["anomaly_score"] <= 1.0 for x in r.values())
