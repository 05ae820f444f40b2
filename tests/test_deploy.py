"""Executors need no copy of the package: run the one Python-worker form from elsewhere."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})  # the driver sees the package; Python workers do not
from pyspark.sql import SparkSession
from enrichkit.operators.ranges import range_lookup
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
keys = spark.createDataFrame([(1, 5), (2, 15), (3, 99)], "id bigint, ipn bigint")
ranges = spark.createDataFrame([(0, 9, "a"), (10, 19, "b")], "start_ip bigint, end_ip bigint, g string")
print("ROWS", sorted(tuple(r) for r in range_lookup(keys, ranges, "ipn", strategy="pandas").collect()))
"""


def test_pandas_strategy_runs_without_the_package_on_workers():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    cwd = tempfile.mkdtemp(prefix="enrichkit-deploy-")  # any folder outside the repo
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS [(1, 5, 0, 9, 'a'), (2, 15, 10, 19, 'b')]" in out.stdout, out.stderr[-2000:]
