"""The driver imports __spark_entry__ by path from another directory; the
Python workers must still find the package (shipped with addPyFile)."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(REPO, '__spark_entry__.py')!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
print("RESULT", E.entry(spark).count() > 0, E.queries()["archive_expand"](spark, "/root/testdata/sf0.001").count())
"""


def test_queries_run_from_another_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert lines == ["RESULT True 25"], out.stderr[-2000:]
