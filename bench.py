"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query is executed in full through the ``noop`` sink (no driver collect).
Each query runs twice and the faster (warm JVM, as in BASELINE's probes) run
is reported; ``first_run`` lists the cold timings too.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_zscore_statistics",
    "rolling_zscore_events",
    "rolling_zscore_by_user",
    "rolling_zscore_lineitem",
    "rolling_iqr_events",
    "rolling_iqr_orders",
    "window_stats_1h",
    "rolling_features",
    "inject_anomalies",
    "classification_report",
    "contamination_threshold",
    "isolation_forest_scores",
    "lof_scores",
    "one_class_svm_scores",
    "ensemble_scores",
    "drift_psi",
    "recent_anomalies_per_source",
    "stream_window_stats",
    "stream_zscore",
    "stream_model_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]]
    from tidemark.session import get_spark
    from tidemark.plans import catalog

    spark = get_spark(cores=cpus, shuffle_partitions=int(cpus) if cpus != "*" else 8)
    # warm-up (JIT, Python workers) on a small table
    catalog.QUERIES["window_stats_1d"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, first, errors = {}, {}, {}
    for name in (only or HEADLINE):
        runs = []
        try:
            for _ in range(2):
                t0 = time.time()
                df = catalog.QUERIES[name](spark, sf_dir)
                df.write.format("noop").mode("overwrite").save()
                runs.append(round(time.time() - t0, 3))
        except Exception as e:  # noqa: BLE001 - report the failure, keep benchmarking the rest
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        times[name], first[name] = min(runs), runs[0]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "first_run": first,
                      "first_run_total": round(sum(first.values()), 3), **({"errors": errors} if errors else {})}))
    spark.stop()


if __name__ == "__main__":
    main()
