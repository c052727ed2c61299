"""The latest partition of a table on disk, from directory names alone."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.functions.timestamps import partition_timestamp
from tripgrain.schema import Grain

# Spark reads no files and directories that begin with these.
HIDDEN = ("_", ".")
WHOLE_NUMBER = re.compile(r"-?\d+")


def _file_system(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _numbered(files, folder, name: str) -> list[tuple[int, object]]:
    """The directories `name=number` of a folder, the largest number first."""
    found = []
    for status in files.listStatus(folder):
        key, _, value = status.getPath().getName().partition("=")
        # NULL partitions have a name in place of a number.
        if status.isDirectory() and key.lower() == name and WHOLE_NUMBER.fullmatch(value):
            found.append((int(value), status.getPath()))
    return sorted(found, key=lambda entry: entry[0], reverse=True)


def _has_data(files, folder) -> bool:
    return any(
        status.isFile() and status.getLen() and not status.getPath().getName().startswith(HIDDEN)
        for status in files.listStatus(folder)
    )


def _with_data(files, folder, names: tuple[str, ...]) -> Iterator[tuple[int, ...]]:
    """Values of the partitions that hold files, in descending order; listed as they are asked for."""
    if not names:
        if _has_data(files, folder):
            yield ()
        return
    for value, inner in _numbered(files, folder, names[0]):
        for finer in _with_data(files, inner, names[1:]):
            yield (value, *finer)


def latest_listed(spark: SparkSession, path: str, grain: Grain) -> datetime | None:
    """Start of the latest partition that holds a file; None if there is none, or no table.

    Goes down from the largest value of each level, so it lists one directory a level unless that
    one turns out empty. No job runs and no file is opened. Partitions with a NULL part are never
    the latest. A file counts as rows: Spark writes none without rows into a partition.
    """
    files, root = _file_system(spark, path)
    if not files.exists(root):
        return None
    latest = next(_with_data(files, root, grain.partitions), None)
    if latest is None:
        return None
    parts = {"day": 1, "hour": 0} | dict(zip(grain.partitions, latest))
    return datetime(**parts)


def latest_partition_listed(spark: SparkSession, path: str, grain: Grain) -> DataFrame:
    """The row that `latest_partition` gives of the table at `path`; NULLs if it has none."""
    latest = latest_listed(spark, path, grain)
    parts = [
        F.lit(None if latest is None else getattr(latest, part)).cast("int").alias(part)
        for part in grain.partitions
    ]
    return spark.range(1).select(*parts).withColumn("latest_ts", partition_timestamp(grain))
