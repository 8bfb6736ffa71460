"""The shared folder for tables that cut lineage or carry work between jobs."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a private temporary one only for a local master."""
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="starhouse-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def _file_system(spark: SparkSession, name: str):
    """Spark has no public call to list or delete files; its file systems are reached through the JVM."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def delete(spark: SparkSession, name: str) -> None:
    system, path = _file_system(spark, name)
    system.delete(path, True)


def folders(spark: SparkSession, name: str) -> list[str]:
    """Names of the folders in a folder, in order; none where it does not exist."""
    system, path = _file_system(spark, name)
    if not system.exists(path):
        return []
    return sorted(f.getPath().getName() for f in system.listStatus(path) if f.isDirectory())


_own = threading.local()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used: one folder per application, one name per call."""
    app = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/starhouse/{app}/{label}-{uuid.uuid4().hex}"
    for open_ in getattr(_own, "paths", []):
        open_.append(path)
    return path


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Deletes, at the end, the scratch tables that this thread makes inside.

    For work whose result is written somewhere else by then. Spark has no public call to
    delete files; where the session offers no way, the tables stay until they are cleared
    with the application's folder.
    """
    if not hasattr(_own, "paths"):
        _own.paths = []
    made: list[str] = []
    _own.paths.append(made)
    try:
        yield
    finally:
        _own.paths.pop()
        if getattr(spark, "_jvm", None) is not None:
            for name in made:
                delete(spark, name)
