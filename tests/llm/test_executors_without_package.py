"""Executors have no copy of the package: all that they run travels with the plan."""

import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RUN = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")

def absent(_):
    import importlib.util
    return [importlib.util.find_spec("roadweave") is None]

assert spark.sparkContext.parallelize([1], 1).mapPartitions(absent).collect() == [True], "the workers have the package"
import __spark_entry__
for name, query in __spark_entry__.queries().items():
    if name.startswith("op") or name == "pipeline":
        query(spark, {sf!r}).write.format("noop").mode("overwrite").save()
        print("ran", name, flush=True)
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_corpus_queries_run_on_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", RUN.format(repo=REPO, sf=SF)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1200, check=False)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran ") >= 14
