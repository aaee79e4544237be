import os
import subprocess
import sys


def test_hot_key_pipeline_survives_failed_tasks():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "failure_run.py")
    out = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=900)
    assert "FAILED_TASKS True" in out.stdout, out.stdout[-2000:] + out.stderr[-2000:]
    assert "RESULT same" in out.stdout, out.stdout[-2000:] + out.stderr[-2000:]
