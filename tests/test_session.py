"""The package reaches the workers, and shared folders are asked for where they are needed."""

import os
import subprocess
import sys

import pytest

from granary import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import importlib.util, sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
spec = importlib.util.spec_from_file_location("entry", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
for name in sys.argv[3:]:
    assert entry.queries()[name](spark, sys.argv[2]).count() > 0, name
"""


def test_udf_modules_are_found_from_another_folder(sf, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    names = [n for n in ("t11_edit_distance", "l07_series_regressions") if n in _names()]
    assert len(names) == 2
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, os.path.join(ROOT, "__spark_entry__.py"), sf, *names],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-1500:]


def _names():
    from granary.plans import catalog

    return catalog()


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session._local_folder(spark, master)


def test_written_tables_are_in_the_shared_folder(spark):
    path = session.shared_path(spark)
    assert path.startswith(session.shared_dir(spark))
    assert session.durable(spark.range(5)).count() == 5
