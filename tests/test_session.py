"""A session that names no checkpoint folder (no spark-defaults): the context's folder is used."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.showConsoleProgress", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from pagelake.session import shared_dir
import __spark_entry__ as entry
folder = shared_dir(spark)
print("SHARED", folder)
print("ROWS", entry.queries()["pages_landed_files"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_fallback_checkpoint_folder_without_defaults():
    if not os.path.isdir("/root/testdata/sf0.001"):
        return
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="pagelake-noconf-"))
    work = tempfile.mkdtemp(prefix="pagelake-cwd-")
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=work, env=env, capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = dict(line.split(" ", 1) for line in out.stdout.splitlines() if line.startswith(("SHARED", "ROWS")))
    assert lines["SHARED"].startswith("file:" + work) and "_checkpoints" in lines["SHARED"]
    assert lines["ROWS"] == "1000"
