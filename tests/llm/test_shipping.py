"""Executors that have the dependencies, but not this package."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DRIVER = """
import sys
from pyspark.sql import SparkSession
sys.path.insert(0, {repo!r})
from tidemark.llm import queries
from tidemark.llm.shared import by_value
from tidemark.llm.secrets import Network
# Python workers get the path that the driver had before it knew the package.
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
given = by_value(spark, [Network])
assert spark.sparkContext.parallelize([0], 1).map(lambda _: given()[0].__name__).collect() == ["Network"]
def known(_):
    import importlib.util
    return importlib.util.find_spec("tidemark") is not None
assert spark.sparkContext.parallelize([0], 1).map(known).collect() == [False]
for name in {names!r}:
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0, name
"""


@pytest.mark.parametrize("names", [["op3_secrets", "op8_quality_model", "op10_decontamination"], ["op12_periodic_runs", "op13_suffix_merge", "op11_prefix_trie"],
                                   ["op2_substrings", "op6_mixing", "op7_licences"]])
def test_queries_run_where_workers_have_no_package(tmp_path, names):
    script = tmp_path / "driver.py"
    script.write_text(DRIVER.format(repo=REPO, names=names))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert done.returncode == 0, done.stderr[-3000:]
