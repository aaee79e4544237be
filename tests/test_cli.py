import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    env = {**os.environ, "PYTHONPATH": ROOT}
    return subprocess.run([sys.executable, "-m", "tidemark", *args], capture_output=True, text=True,
                          timeout=600, env=env, cwd=tempfile.gettempdir())


def test_cli_list_and_run():
    out = _run("list")
    assert out.returncode == 0 and "rolling_zscore_events (sql oracle)" in out.stdout
    assert "one_class_svm_scores" in out.stdout
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-cli-"), "res")
    r = _run("run", "flagship_zscore_statistics", "--sf", "/root/testdata/sf0.001", "--out", target)
    assert r.returncode == 0, r.stderr[-2000:]
    assert any(f.endswith(".parquet") for f in os.listdir(target))
    assert _run("run", "no_such_query").returncode == 2
