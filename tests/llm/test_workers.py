"""Operators on workers that cannot import the package: the driver runs in another folder."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]

PROBE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__, corpus_pipeline
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
found = spark.range(1).rdd.mapPartitions(lambda rows: [__import__("importlib.util").util.find_spec("refmill") is not None]).collect()
assert not any(found), "workers see the package"
for name, run in __spark_entry__.queries().items():
    if name.startswith("op") or name == "pipeline":
        print(name, run(spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_workers_need_no_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROBE, str(ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-3000:]
    assert len(done.stdout.split("\n")) > 13
