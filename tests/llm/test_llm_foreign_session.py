"""The queries must run on a session made elsewhere, from another folder, without PYTHONPATH."""

import os
import subprocess
import sys

import pytest

pytest.importorskip("statloom.llm.queries")

SCRIPT = """
import importlib.util
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2")
         .config("spark.ui.enabled", "false").getOrCreate())
spec = importlib.util.spec_from_file_location("entry", {path!r})
module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(module)
for name, rows in (("op4_license_scan", 200), ("op9_warc", 50), ("op3_packing", 200), ("op7_quality", 200)):
    assert module.queries()[name](spark, {sf!r}).count() >= rows, name
print("fine")
"""


def test_plain_session(tmp_path, sf):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = SCRIPT.format(path=os.path.join(root, "__spark_entry__.py"), sf=sf)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert done.stdout.strip().endswith("fine"), done.stderr[-3000:]
