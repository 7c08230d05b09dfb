"""Executors and other working directories need no copy of the package."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROBE = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", sys.argv[1] + "/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from headway.session import build_session
spark = build_session("probe", "local[2]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"})
print("ROWS", entry.entry(spark).count(), entry.queries()["scan_zip_members"](spark, entry.SMOKE_TABLES).count())
"""


def test_entry_from_a_foreign_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", PROBE, ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "ROWS" in done.stdout, done.stderr[-2000:]
    assert all(int(n) > 0 for n in done.stdout.split("ROWS")[1].split())
