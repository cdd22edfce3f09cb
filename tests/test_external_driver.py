"""The driver contract from outside the repository: a plain session (no
library settings), another working directory, the entry file loaded by path.
Stateful stream processors must reach the Python workers without an install."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(ROOT, "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2")
         .config("spark.ui.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
print("ENTRY", E.entry(spark).count())
print("STREAM", E.queries()["stream_inactivity_timeout"](spark, "/root/testdata/sf0.001").count())
"""


def test_entry_and_stateful_stream_from_another_directory():
    work = tempfile.mkdtemp(prefix="eventide-ext-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=work, env=env, capture_output=True,
                       text=True, timeout=600)
    out = r.stdout
    assert r.returncode == 0, r.stderr[-3000:]
    assert "ENTRY " in out and "STREAM " in out
    assert int(out.split("STREAM ")[1].split()[0]) > 0
