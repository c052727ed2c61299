"""Publish partitioned tables so that a reader sees the old or the new one, never a mixture.

A writer puts its rows under `data/version=…`, where nobody looks for them yet. It then stages the
next manifest, a table of every partition with the version that holds it, and publishes it by one
rename to `manifests/number=N`. A rename to a name that is taken fails, so of two writers that start
from the same manifest one is refused. Data and manifests are never changed, so a reader keeps the
version it began with. A writer that is lost leaves files that no manifest names.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OVERWRITE, REPLACE, APPEND = "overwrite", "replace", "append"


class PublicationConflict(RuntimeError):
    """Another writer published first; what was written stands on an older version."""


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def latest_version(spark: SparkSession, path: str) -> int:
    """Number of the last published manifest; 0 before the first."""
    files, folder = _file_system(spark, f"{path}/manifests")
    if not files.exists(folder):
        return 0
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    numbers = [int(name.removeprefix("number=")) for name in names if name.startswith("number=")]
    return max(numbers, default=0)


def _kinds(partitions: Sequence[str]) -> str:
    return ", ".join(f"`{part}` int" for part in partitions)


def manifest(spark: SparkSession, path: str, partitions: Sequence[str], number: int) -> DataFrame:
    """Every partition with the version, or versions, that hold its rows."""
    kinds = f"{_kinds(partitions)}, version string, writer string"
    if not number:
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).parquet(f"{path}/manifests/number={number}")


def _same(one: DataFrame, other: DataFrame, names: Sequence[str]):
    return reduce(and_, [one[name].eqNullSafe(other[name]) for name in names])


def stage(table: DataFrame, partitions: Sequence[str], path: str) -> str:
    """Write rows where no reader finds them; returns the name of their version."""
    version = f"v{uuid.uuid4().hex}"
    rebalanced = table.hint("rebalance", *partitions)
    rebalanced.write.partitionBy(*partitions).parquet(f"{path}/data/version={version}")
    return version


def commit(
    spark: SparkSession,
    path: str,
    partitions: Sequence[str],
    version: str,
    mode: str,
    base: int,
) -> int:
    """Publish a staged version on top of manifest `base`; returns the new number.

    `overwrite` leaves only the new rows, `replace` puts whole partitions in place of those of the
    same values, `append` adds to them. Raises `PublicationConflict` if `base` is not the last.
    """
    if mode not in (OVERWRITE, REPLACE, APPEND):
        raise ValueError(f"mode must be {OVERWRITE}, {REPLACE} or {APPEND}, not {mode!r}")
    # Only partition values are asked for, so no data column is read.
    written = spark.read.schema(_kinds(partitions)).parquet(f"{path}/data/version={version}")
    entries = written.select(*partitions).distinct().withColumn("version", F.lit(version))
    if mode != OVERWRITE:
        old = manifest(spark, path, partitions, base).drop("writer")
        if mode == REPLACE:
            old = old.join(entries, _same(old, entries, partitions), "left_anti")
        entries = old.unionByName(entries)
    writer = uuid.uuid4().hex
    staged, published = f"{path}/manifests/_{writer}", f"{path}/manifests/number={base + 1}"
    # One row per partition of the table, and version under `append`.
    entries.withColumn("writer", F.lit(writer)).coalesce(1).write.parquet(staged)
    files, target = _file_system(spark, published)
    if not _renamed(spark, files, staged, target) or not _is_ours(files, target, writer):
        raise PublicationConflict(f"manifest {base + 1} of {path} is taken")
    return base + 1


def _renamed(spark: SparkSession, files, staged: str, target) -> bool:
    """Rename without taking the place of what is there; a mark names the writer."""
    jvm = spark._jvm
    source = jvm.org.apache.hadoop.fs.Path(staged)
    files.create(jvm.org.apache.hadoop.fs.Path(staged, _mark(staged.rpartition("/_")[2]))).close()
    options = spark.sparkContext._gateway.new_array(
        getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0
    )
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri() if target.toUri().getScheme() else files.getUri(),
        spark._jsc.hadoopConfiguration(),
    )
    try:
        context.rename(files.makeQualified(source), files.makeQualified(target), options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _mark(writer: str) -> str:
    return f"_by-{writer}"


def _is_ours(files, target, writer: str) -> bool:
    """Where a file system checks and renames in two steps, both writers may come through."""
    names = [status.getPath().getName() for status in files.listStatus(target)]
    return [name for name in names if name.startswith("_by-")] == [_mark(writer)]


def publish(table: DataFrame, partitions: Sequence[str], path: str, mode: str) -> int:
    """Write rows and publish them on top of the version that is the last when writing begins."""
    spark = table.sparkSession
    base = latest_version(spark, path)
    return commit(spark, path, partitions, stage(table, partitions, path), mode, base)


def read_published(
    spark: SparkSession, path: str, partitions: Sequence[str], number: int | None = None
) -> DataFrame:
    """The table as of a version, by default the last one; it does not change under the reader.

    The versions in use are constants of the scan, so directories of others are not read. Their
    number is that of publications since the last `overwrite`.
    """
    number = latest_version(spark, path) if number is None else number
    if not number:
        raise ValueError(f"nothing is published at {path}")
    entries = manifest(spark, path, partitions, number).drop("writer")
    versions = sorted(row["version"] for row in entries.select("version").distinct().collect())
    stored = spark.read.parquet(f"{path}/data")
    stored = stored.filter(F.col("version").isin(versions))
    found = stored.join(entries, _same(stored, entries, ["version", *partitions]), "left_semi")
    return found.drop("version")
