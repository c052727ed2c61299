"""Read position samples, in full or after a watermark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.functions.timestamps import partition_timestamp
from tripgrain.schema import Grain
from tripgrain.sources.listing import latest_listed


def partitions_after(grain: Grain, watermark: datetime) -> Column:
    """True for partitions strictly later than the watermark's own partition.

    Spelled out as comparisons of single columns with constants, which file listings and
    metastores can prune by.
    """
    year, *finer = grain.partitions
    later = F.lit(False)
    for part in reversed(finer):
        later = (F.col(part) > getattr(watermark, part)) | (
            (F.col(part) == getattr(watermark, part)) & later
        )
    newer_year = F.col(year) > watermark.year
    same_year = F.col(year) == watermark.year
    return (F.col(year) >= watermark.year) & (newer_year | (same_year & later))


def partitions_from(grain: Grain, first: datetime) -> Column:
    """True for the partition of `first` and all later ones."""
    same = F.lit(True)
    for part in grain.partitions:
        same = same & (F.col(part) == getattr(first, part))
    year = grain.partitions[0]
    return (F.col(year) >= first.year) & (same | partitions_after(grain, first))


def incremental(positions: DataFrame, grain: Grain, watermark: datetime) -> DataFrame:
    """Samples of the partitions later than the watermark."""
    return positions.filter(partitions_after(grain, watermark))


def read_positions(
    spark: SparkSession,
    path: str,
    grain: Grain,
    watermark: datetime | None = None,
) -> DataFrame:
    """The partitioned Parquet table at `path`; with a watermark, only the later partitions."""
    positions = spark.read.parquet(path)
    return positions if watermark is None else incremental(positions, grain, watermark)


def latest_partition(table: DataFrame, grain: Grain) -> DataFrame:
    """One row: the latest partition of a table and its start time.

    NULL parts (rows without a date) never are the latest.
    """
    parts = F.max(F.struct(*grain.partitions)).alias("latest")
    return (
        table.dropna(subset=list(grain.partitions))
        .agg(parts)
        .select("latest.*")
        .withColumn("latest_ts", partition_timestamp(grain))
    )


def latest_partition_sql(table: DataFrame, grain: Grain) -> DataFrame:
    """The same by grouping and sorting in SQL over a temporary view of the table."""
    parts = ", ".join(grain.partitions)
    largest = ", ".join(f"max({part}) AS {part}" for part in grain.partitions)
    descending = ", ".join(f"{part} DESC" for part in grain.partitions)
    latest = table.sparkSession.sql(
        f"SELECT {largest} FROM {{gold}} GROUP BY {parts} ORDER BY {descending} LIMIT 1",
        gold=table.dropna(subset=list(grain.partitions)),
    )
    return latest.withColumn("latest_ts", partition_timestamp(grain))


def watermark_of(spark: SparkSession, path: str, grain: Grain) -> datetime | None:
    """Start time of the latest partition in a gold table; None if it has no dated row.

    Told from directory names, so no job runs and no file is opened. A directory left empty by a
    lost full load is an empty table.
    """
    return latest_listed(spark, path, grain)


CONSUMED = "_consumed"


def note_consumed(
    spark: SparkSession, path: str, grain: Grain, latest: datetime | None
) -> None:
    """Record beside the gold partitions up to which source partition they are complete.

    The folder's name keeps it out of table scans. A full overwrite of the table removes it.
    """
    if latest is None:
        return
    row = spark.createDataFrame([(latest,)], "consumed timestamp_ntz")
    row.coalesce(1).write.mode("append").parquet(f"{path}/{CONSUMED}")


def consumed_until(spark: SparkSession, path: str, grain: Grain) -> datetime | None:
    """Start of the last source partition that a complete load consumed; None if not recorded."""
    noted = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{CONSUMED}")
    if not noted.getFileSystem(spark._jsc.hadoopConfiguration()).exists(noted):
        return None
    rows = spark.read.schema("consumed timestamp_ntz").parquet(f"{path}/{CONSUMED}")
    return rows.agg(F.max("consumed").alias("latest")).first()["latest"]
