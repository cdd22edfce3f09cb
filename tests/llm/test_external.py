"""All training-data queries from outside the repository: a plain session,
another working directory, workers that cannot import the library."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(ROOT, "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "3")
         .config("spark.ui.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
for name, q in E.queries().items():
    if name.startswith("op") or name == "pipeline":
        print("ROWS", name, q(spark, "/root/testdata/sf0.001").count())
"""


def test_queries_without_the_repository_on_the_workers():
    work = tempfile.mkdtemp(prefix="eventide-ext-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=work, env=env, capture_output=True, text=True, timeout=900)
    assert r.returncode == 0, r.stderr[-3000:]
    got = dict(x.split()[1:] for x in r.stdout.splitlines() if x.startswith("ROWS "))
    assert len(got) == 14 and all(int(n) > 0 for k, n in got.items() if k != "op8_containment"), got
