"""Every registered query against its SQL text (DuckDB) on the smallest tables."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF001  # noqa: E402

from tidemark.plans import catalog  # noqa: E402

# the training-data queries have tests of their own
QUERIES = {k: f for k, f in E.queries().items() if k in catalog.QUERIES}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    from oracle_check import duck
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    from oracle_check import compare
    status, msg = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF001)
    assert status in ("ok", "rows-only"), msg
    if name not in ORACLE:
        assert name in ("one_class_svm_scores", "model_registry_latest")


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and set(df.columns) >= {"source", "processed_count", "anomaly_count"}
