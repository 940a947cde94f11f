"""Cutting lineage on shared storage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, which all executors have to share.

    Only a local master may run without that setting; it then gets a temporary folder that goes with
    the process. On a cluster a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get(SETTING, None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that the driver and all executors share")
    if current is None:
        own = tempfile.mkdtemp(prefix="ledgerweb-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(own)
        current = spark.sparkContext.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` reliably, so that later plans start from stored rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as Parquet on the shared storage, read back: column pruning and sizes stay known.

    For tables that are joined again. Two stored tables meet straight from their shuffles, where
    adaptive execution can split a hot key.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/ledgerweb/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name on the shared storage, for tables a job writes and reads back."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all folders that `scratch_path` named in this application; results not yet read are lost."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
