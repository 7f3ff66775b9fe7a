"""The registered queries need neither the working directory nor a search path to be that of the repository."""

import os
import subprocess
import sys
from pathlib import Path

RUN = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__ as entry
session = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[3])
print("rows", entry.queries()["stream_indicators"](session.getOrCreate(), sys.argv[2]).count())
"""


def test_stateful_stream_from_another_folder(sf_dir, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("PYSPARK_GATEWAY")}
    root = str(Path(__file__).parents[1])
    done = subprocess.run([sys.executable, "-c", RUN, root, sf_dir, str(tmp_path / "shared")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 960" in done.stdout, done.stderr[-3000:]
