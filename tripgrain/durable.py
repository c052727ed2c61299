"""Shared-storage scratch space that outlives a lost executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _is_local(master: str) -> bool:
    """True if all tasks run in the driver's own process, so that its folders are shared."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The one folder for checkpoints and scratch tables, which all executors reach.

    It is the application's own checkpoint folder, else the one that `spark.checkpoint.dir`
    names; a temporary one only where everything runs in one process.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not _is_local(context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tripgrain-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute `df` once, store it in the checkpoint folder and read it from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
