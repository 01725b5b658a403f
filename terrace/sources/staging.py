"""Intermediate tables in the cluster's shared folder.

A derived input that several branches read is written once and read back, so
it is neither recomputed per branch nor lost with an executor. Being a file
table, it also has a true size, from which Spark decides by itself whether a
join side is small enough to broadcast.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_scope = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a scratch folder only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor reaches")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="terrace-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    folder = f"{_app_dir(spark)}/{uuid.uuid4().hex}"
    if getattr(_scope, "folders", None) is not None:
        _scope.folders.append(folder)
    return f"{folder}/{label}"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Remove what this thread stages inside, at the end; nothing lazy may outlive it."""
    outer = getattr(_scope, "folders", None)
    _scope.folders = []
    try:
        yield
    finally:
        folders, _scope.folders = _scope.folders, outer
        for folder in folders:
            _delete(spark, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _app_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/terrace/{spark.conf.get('spark.app.id', 'local')}"


def drop_staged(spark: SparkSession) -> None:
    """Remove this application's staged tables once no lazy result reads them any more."""
    _delete(spark, _app_dir(spark))


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back with the same schema."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
