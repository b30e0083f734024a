"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder that ``spark.checkpoint.dir`` names.

    The folder must be visible to every executor, so a machine-local default is only
    made up for a local session. What is written there goes away with the driver.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    path = f"{root.rstrip('/')}/levyflow/{label}-{uuid.uuid4().hex}"
    _delete_with_driver(spark, path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder before the driver ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="levyflow-")


def _delete_with_driver(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    # Hadoop only accepts a path that exists; the writers overwrite it.
    files.mkdirs(target)
    files.deleteOnExit(target)
