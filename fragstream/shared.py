"""The folder that the driver and all executors share, and cutting lineage in it."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver can reach (``spark.checkpoint.dir``).

    Only where the setting is absent and the master is local, as in tests, a
    temporary folder of this machine takes its place; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    held = sc._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    made = tempfile.mkdtemp(prefix="fragstream-")
    atexit.register(shutil.rmtree, made, True)
    sc.setCheckpointDir(f"file://{made}")
    return f"file://{made}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint in the shared folder; Spark removes it when nothing refers to it any more."""
    shared_dir(df.sparkSession)
    return df.checkpoint(True)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system of the path, function that makes a Hadoop path)."""
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def delete_path(spark: SparkSession, path: str) -> None:
    fs, make = file_system(spark, path)
    fs.delete(make(path), True)
