"""The shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_local_scratch: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see.

    On a cluster it must be named in ``spark.checkpoint.dir``.  Only a local
    master, where one machine runs every task, may fall back to a scratch folder.
    """
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_scratch:
        _local_scratch[application] = tempfile.mkdtemp(prefix="rankspark-")
    return _local_scratch[application]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's part of the shared folder, which goes at its end."""
    return f"{_application_dir(spark)}/{name}-{uuid.uuid4().hex}"


_application_dirs: dict[str, str] = {}


def _application_dir(spark: SparkSession) -> str:
    """Its full URI, by which tasks find it too, whatever their default file system is."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    if path not in _application_dirs:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(folder)
        system.deleteOnExit(folder)
        uri = system.makeQualified(folder).toString()
        _application_dirs[path] = re.sub("^file:/(?!/)", "file:///", uri)
    return _application_dirs[path]


def prepare_checkpoints(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint()`` write below the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
