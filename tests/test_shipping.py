"""Queries whose Python steps use this package run from any folder."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as entry
from prosewell.session import local_session
spark = local_session("elsewhere", 2, "2g")
print("rows", entry.queries()["G3_cluster_features"](spark, sys.argv[1]).count())
"""


def test_from_another_folder(folder, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, folder], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "rows 64" in done.stdout, done.stderr[-2000:]
