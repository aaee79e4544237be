import random

from pyspark.sql import functions as F

from conftest import SF01, rows
from tidemark.operators.quantile import exact_percentile
from tidemark.operators import split as sp


def _qcont(vals, q):
    vals = sorted(vals)
    h = (len(vals) - 1) * q
    i = int(h)
    x0 = vals[i]
    x1 = vals[min(i + 1, len(vals) - 1)]
    return x0 + (h - i) * (x1 - x0)


def test_exact_percentile_narrowing(spark):
    rnd = random.Random(3)
    data = [(k, rnd.gauss(50, 10)) for k in ("a", "b") for _ in range(5000)] + [("c", 7.0)] * 3000
    df = spark.createDataFrame(data, "k string, v double")
    for q in (0.1, 0.5, 0.9, 0.0, 1.0):
        got = {r["k"]: r["percentile"] for r in
               exact_percentile(df, "v", q, ["k"], bins=16, max_candidates=50).collect()}
        for k in ("a", "b", "c"):
            exp = _qcont([v for kk, v in data if kk == k], q)
            assert abs(got[k] - exp) < 1e-9, (q, k, got[k], exp)
    g = exact_percentile(df, "v", 0.37, bins=8, max_candidates=100).first()["percentile"]
    assert abs(g - _qcont([v for _, v in data], 0.37)) < 1e-9


def test_exact_percentile_of_outliers_infinities_and_ties(spark):
    rnd = random.Random(4)
    inf = float("inf")
    data = [("out", v) for v in [rnd.gauss(0, 1) for _ in range(800)] + [1.7e308, -1.7e308, inf, -inf]]
    data += [("ties", float(rnd.randrange(3))) for _ in range(900)] + [("nan", float("nan")), ("nan", None), ("nan", 5.0)]
    df = spark.createDataFrame(data, "k string, v double")
    for q in (0.0, 0.013, 0.5, 0.777, 1.0):
        got = {r["k"]: r["percentile"] for r in exact_percentile(df, "v", q, ["k"], bins=8, max_candidates=20).collect()}
        assert got["nan"] == 5.0
        for k in ("out", "ties"):
            exp = _qcont([v for kk, v in data if kk == k], q) if q in (0.5, 0.777, 0.013) else (min if q == 0 else max)(v for kk, v in data if kk == k)
            assert got[k] == exp or abs(got[k] - exp) < 1e-9, (q, k)


def test_time_series_folds_rule(spark):
    df = spark.range(0, 103).withColumnRenamed("id", "t")
    out = sp.time_series_folds(df, ["t"], k=5)
    got = {}
    for r in out.collect():
        got.setdefault((r["fold"], r["role"]), []).append(r["t"])
    n, k = 103, 5
    t = n // (k + 1)
    for i in range(k):
        start = n - (k - i) * t
        assert sorted(got[(i, "train")]) == list(range(0, start))
        assert sorted(got[(i, "test")]) == list(range(start, start + t))


def test_global_positions_chunked(spark):
    from tidemark.sources import tables as tb
    ev = tb.readings(spark, SF01)
    pos = sp.with_positions(ev, ["timestamp", "event_id"], chunk_rows=700)
    r = rows(pos.select("event_id", "_pos"))
    assert [p for _, p in r] == list(range(10000))  # ts rises with event_id


def test_global_positions_skewed_values(spark):
    # heavy-tailed order value: quantile buckets keep positions exact
    import math
    from tidemark.operators.rolling import positions, RN
    data = [(i, math.exp(i % 97 / 4.0) if i % 5 else 1e9 + i) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, v double")
    got = {r["id"]: r[RN] for r in positions(df, [], ["v", "id"], part_rows=200, single_task_rows=0).collect()}
    exp = {i: k + 1 for k, (i, _) in enumerate(sorted(data, key=lambda t: (t[1], t[0])))}
    assert got == exp


def test_positions_hot_key_with_duplicate_order_values(spark):
    # one key holds most rows and a third of all rows share one order value:
    # positions stay exact (ranges are cut on the whole (key, order) tuple)
    from tidemark.operators.rolling import positions, RN
    data = [(("hot" if i % 4 else f"k{i % 7}"), (5.0 if i % 3 == 0 else float(i % 50)), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, t double, id long")
    got = {r["id"]: r[RN] for r in positions(df, ["k"], ["t", "id"], part_rows=150).collect()}
    exp = {}
    for key in {d[0] for d in data}:
        grp = sorted((d for d in data if d[0] == key), key=lambda d: (d[1], d[2]))
        exp.update({d[2]: j + 1 for j, d in enumerate(grp)})
    assert got == exp
    w = {r["id"]: r[RN] for r in positions(df.withColumn("w", (F.col("id") % 2).cast("int")), ["k"], ["t", "id"],
                                           part_rows=150, weight="w").collect()}
    expw = {}
    for key in {d[0] for d in data}:
        c = 0
        for d in sorted((d for d in data if d[0] == key), key=lambda d: (d[1], d[2])):
            c += d[2] % 2
            expw[d[2]] = c
    assert w == expw


def test_keyless_weighted_positions_both_paths(spark):
    from tidemark.operators.rolling import positions, RN
    data = [(i, float(i % 37), i % 3 == 0) for i in range(2000)]
    df = spark.createDataFrame(data, "id long, v double, w boolean").withColumn("w", F.col("w").cast("int"))
    exp, c = {}, 0
    for i, v, w in sorted(data, key=lambda d: (d[1], d[0])):
        c += int(w)
        exp[i] = c
    for single in (0, 10**6):
        got = {r["id"]: r[RN] for r in positions(df, [], ["v", "id"], part_rows=100, weight="w",
                                                  single_task_rows=single).collect()}
        assert got == exp
