"""The shared folder."""

import subprocess
import sys
import time
from pathlib import Path
from types import SimpleNamespace

import pytest

from rankspark import runtime

ROOT = Path(__file__).resolve().parents[1]

class Session:
    def __init__(self, master, folder=None):
        self.conf = SimpleNamespace(get=lambda key, default: folder or default)
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"{master}-app")


def test_configured_folder_is_used():
    assert runtime.shared_dir(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_cluster_without_folder_fails():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_dir(Session("yarn"))


def test_local_master_gets_one_scratch_folder():
    session = Session("local[2]")
    assert runtime.shared_dir(session) == runtime.shared_dir(session)


def test_new_folders_differ(spark):
    first, second = runtime.new_folder(spark, "x"), runtime.new_folder(spark, "x")
    assert first != second and runtime.shared_dir(spark) in first and first.startswith("file:///")


def test_folders_go_when_the_application_ends(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from rankspark.runtime import new_folder
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", "{tmp_path}").getOrCreate())
path = new_folder(spark, "x")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3
spark.stop()
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    for _ in range(60):  # the JVM ends a little later
        if not list(tmp_path.glob("local-*")):
            break
        time.sleep(0.5)
    assert not list(tmp_path.glob("local-*"))
