import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.base import SeriesSpec
from tidemark.operators.isolation_forest import IsolationForestDetector, avg_path_length
from tidemark.operators.lof import LOFDetector

SPEC = SeriesSpec((), ("id",), "value", "id")


def _normal_df(spark, n=1000, seed=42):
    rng = np.random.default_rng(seed)
    vals = rng.normal(50, 10, n)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id long, value double"), vals


def _probe(spark, values, start=100000):
    return spark.createDataFrame([(start + i, float(v)) for i, v in enumerate(values)], "id long, value double")


def test_avg_path_length():
    assert avg_path_length(1) == 0.0 and avg_path_length(2) == 1.0
    assert abs(avg_path_length(256) - 10.244770920116851) < 1e-9


def test_isolation_forest_properties(spark):
    df, _ = _normal_df(spark)
    m = IsolationForestDetector(SPEC, contamination=0.1).fit(df)
    out = m.transform(df)
    share = out.where("is_anomaly").count() / 1000
    assert abs(share - 0.1) <= 0.02
    r = {row["value"]: row for row in m.transform(_probe(spark, [50.0, 100.0, 0.0])).collect()}
    assert r[100.0]["is_anomaly"] and r[0.0]["is_anomaly"] and not r[50.0]["is_anomaly"]
    assert 0 < r[50.0]["anomaly_score"] < r[100.0]["anomaly_score"] <= 1
    assert r[100.0]["anomaly_type"] == "isolation_forest"
    assert abs(r[100.0]["reference_score"] - 1 - r[100.0]["anomaly_score"]) < 1e-12
    # every value of a tree lies in exactly one leaf: the mean path is within [0, depth + c(psi)]
    mp = m.intervals.agg(F.min("mean_path"), F.max("mean_path")).first()
    assert 0 < mp[0] <= mp[1] <= 8 + avg_path_length(256)


def test_isolation_forest_large_n_sampling(spark):
    # n >= trees * psi: dealt top-k sample path
    df, _ = _normal_df(spark, n=3000, seed=1)
    m = IsolationForestDetector(SPEC, contamination=0.05, n_estimators=10, max_samples=64).fit(df)
    share = m.transform(df).where("is_anomaly").count() / 3000
    assert abs(share - 0.05) <= 0.02


def _brute_lof(train, k, new):
    n = len(train)
    order = np.lexsort((np.arange(n), train))
    D = np.abs(train[:, None] - train[None, :])
    np.fill_diagonal(D, np.inf)
    nb = np.argsort(D, axis=1, kind="stable")[:, :k]
    kd = np.take_along_axis(D, nb, axis=1)[:, -1]
    reach = np.maximum(np.take_along_axis(D, nb, axis=1), kd[nb])
    lrd = 1.0 / (reach.mean(axis=1) + 1e-10)
    lof = lrd[nb].mean(axis=1) / lrd
    Dn = np.abs(new[:, None] - train[None, :])
    nbn = np.argsort(Dn, axis=1, kind="stable")[:, :k]
    rn = np.maximum(np.take_along_axis(Dn, nbn, axis=1), kd[nbn])
    lrdn = 1.0 / (rn.mean(axis=1) + 1e-10)
    lofn = lrd[nbn].mean(axis=1) / lrdn
    return lof, lofn


@pytest.mark.parametrize("chunk", [1_000_000, 64])
def test_lof_equals_brute_force(spark, chunk):
    df, vals = _normal_df(spark, n=300, seed=5)
    m = LOFDetector(SPEC, contamination=0.1, n_neighbors=20, chunk_rows=chunk).fit(df)
    x = (vals - vals.mean()) / vals.std()
    new_vals = np.array([50.0, 55.5, 100.0, 0.0, 20.0, 80.0] + list(vals[:5]))
    lof, lofn = _brute_lof(x, 20, (new_vals - vals.mean()) / vals.std())
    got = {r["_id"]: r["lof"] for r in m.train.select("_id", "lof").collect()}
    for i in range(300):
        assert abs(got[i] - lof[i]) < 1e-9
    offset = np.percentile(-lof, 10)
    assert abs(m.offset - offset) < 1e-9
    out = {r["id"]: r for r in m.transform(_probe(spark, new_vals)).collect()}
    for i, v in enumerate(new_vals):
        r = out[100000 + i]
        dec = -lofn[i] - offset
        assert abs(r["reference_score"] - (1 - dec)) < 1e-9, (v, r["reference_score"], 1 - dec)
        assert r["is_anomaly"] == (dec < 0)
    assert out[100002]["is_anomaly"] and out[100003]["is_anomaly"]


def test_lof_duplicates_match_brute_force_with_same_tie_rule(spark):
    # integer values repeated many times: zero distances and distance ties.
    # Ties are broken by position in (value, id) order; the brute force uses the
    # same rule by indexing the data in that order.
    rng = np.random.default_rng(11)
    vals = rng.integers(0, 12, 240).astype(float)
    ids = np.arange(240)
    order = np.lexsort((ids, vals))
    sv, sid = vals[order], ids[order]
    df = spark.createDataFrame([(int(i), float(v)) for i, v in zip(sid, sv)], "id long, value double")
    m = LOFDetector(SPEC, contamination=0.1, n_neighbors=10).fit(df)
    x = (sv - sv.mean()) / sv.std()
    lof, _ = _brute_lof(x, 10, np.array([0.0]))
    got = {r["_id"]: r["lof"] for r in m.train.select("_id", "lof").collect()}
    for pos, i in enumerate(sid):
        assert abs(got[int(i)] - lof[pos]) <= 1e-9 * max(1.0, abs(lof[pos])), (i, got[int(i)], lof[pos])


def test_lof_of_a_chunk_is_found_block_by_block(monkeypatch):
    import pyarrow as pa
    from tidemark.operators import lof as m
    rng = np.random.default_rng(2)
    x = np.sort(np.concatenate([rng.normal(size=200), rng.integers(-2, 3, 60).astype(float)]))
    order = rng.permutation(len(x))  # rows of a group come in any order; a third are copies of border rows
    table = pa.table({"rn": order + 1, "x": x[order], "_id": order * 10, "shift": (order % 3 == 0).astype(np.int32)})
    monkeypatch.setattr(m, "BLOCK_ROWS", 50)
    got = m._chunk_factors(7, 1.0)(table)
    want, _ = _brute_lof(x, 7, np.array([0.0]))
    kept = np.flatnonzero(np.arange(len(x)) % 3 != 0)
    assert got["rn"].to_pylist() == (kept + 1).tolist() and got["_id"].to_pylist() == (kept * 10).tolist()
    assert np.allclose(got["lof"].to_numpy(), want[kept], rtol=1e-9, atol=0)


def test_empty_and_missing_inputs(spark):
    from tidemark.operators.evaluate import evaluate
    empty = spark.createDataFrame([], "id long, value double")
    with pytest.raises(ValueError):
        IsolationForestDetector(SPEC).fit(empty)
    with pytest.raises(ValueError):
        LOFDetector(SPEC).fit(empty)
    scored = spark.createDataFrame([(True, 0.9), (False, 0.1)], "is_anomaly boolean, anomaly_score double")
    r = evaluate(scored, "label").first()  # no label column -> unlabelled metrics
    assert set(r.asDict()) == {"anomaly_rate", "avg_score", "score_std"} and r.anomaly_rate == 0.5


def test_one_class_svm_scoring_matches_numpy(spark):
    from tidemark.operators.ocsvm import OneClassSVMDetector
    df, vals = _normal_df(spark, n=1500, seed=9)
    m = OneClassSVMDetector(SPEC, nu=0.1, max_iter=50).fit(df)
    # the fit's mean / std are the population statistics of the data
    assert abs(m.mean - vals.mean()) < 1e-9 and abs(m.sd - vals.std()) < 1e-9
    probe = np.array([50.0, 61.3, 75.0, 100.0, 0.0, 20.5])
    got = {r["value"]: r["reference_score"] for r in m.transform(_probe(spark, probe)).collect()}
    x = (probe - m.mean) / m.sd
    phi = np.sqrt(2.0 / len(m.W)) * np.cos(np.outer(x, m.W) + m.B)
    dec = phi @ m.w - m.rho
    for v, d in zip(probe, dec):
        assert abs(got[v] - (1.0 - d)) < 1e-9
    # flagged share on the training rows is close to nu (rho is the nu-quantile)
    share = m.transform(df).where("is_anomaly").count() / 1500
    assert abs(share - 0.1) < 0.02


def test_isolation_forest_auto_contamination(spark):
    df, _ = _normal_df(spark, n=800, seed=4)
    m = IsolationForestDetector(SPEC, contamination="auto", n_estimators=30).fit(df)
    assert m.threshold == 0.5
    out = m.transform(df).select("is_anomaly", "anomaly_score").collect()
    assert all(r.is_anomaly == (r.anomaly_score > 0.5) for r in out)
