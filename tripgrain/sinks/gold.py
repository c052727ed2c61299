"""Write gold tables and keep their catalog entries up to date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.schema import Grain

FULL_LOAD = "FULL_LOAD"
INCREMENTAL = "INCREMENTAL"

# Fixed value: the directory name Spark gives to a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

ADDED_PER_STATEMENT = 1000


def _write(
    table: DataFrame, partitions: Sequence[str], path: str, mode: str, replaces: str = "static"
) -> None:
    # A static overwrite replaces the whole table, whatever the session says about partitions.
    writer = table.write.mode(mode).option("partitionOverwriteMode", replaces)
    writer.partitionBy(*partitions).parquet(path)


def write_partitioned(table: DataFrame, partitions: Sequence[str], path: str, mode: str) -> None:
    """Partitioned Parquet of any size: `rebalance` merges small and splits large partitions."""
    _write(table.hint("rebalance", *partitions), partitions, path, mode)


def write_gold(gold: DataFrame, grain: Grain, path: str, load_type: str) -> None:
    """A full load replaces the gold table, an incremental one adds to it."""
    mode = "append" if load_type == INCREMENTAL else "overwrite"
    _write(_by_directory(gold, grain), grain.partitions, path, mode)


def replace_partitions(gold: DataFrame, grain: Grain, path: str) -> None:
    """Write whole partitions in place of those of the same values; others stay."""
    _write(_by_directory(gold, grain), grain.partitions, path, "overwrite", "dynamic")


def _by_directory(gold: DataFrame, grain: Grain) -> DataFrame:
    """A directory holds few rows (31 at most), so each is one file from one task.

    The number of tasks is set, because adaptive execution would merge such small data into one
    task that writes all directories one after the other.
    """
    tasks = int(gold.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return gold.repartition(tasks, *grain.partitions)


def partition_paths(gold: DataFrame, grain: Grain) -> DataFrame:
    """One `partition_path` such as `year=2024/month=1/` for each partition present."""
    present = gold.select(*grain.partitions).distinct()
    directories = [
        F.concat(
            F.lit(f"{part}="),
            F.coalesce(F.col(part).cast("string"), F.lit(NULL_PARTITION)),
            F.lit("/"),
        )
        for part in grain.partitions
    ]
    return present.select(F.concat(*directories).alias("partition_path"))


def target_exists(spark: SparkSession, table: str, path: str) -> bool:
    """True if the table is in the catalog and its directory is there."""
    if not spark.catalog.tableExists(table):
        return False
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def quoted(name: str) -> str:
    """A table name, with its catalog and database if given, as SQL reads it whatever it holds."""
    parts = name.split(".") if "`" not in name else [name.strip("`")]
    return ".".join(f"`{part}`" for part in parts)


def check_owner(spark: SparkSession, table: str, path: str) -> None:
    """Refuse a table name that stands for anything but our external Parquet table at `path`."""
    if not spark.catalog.tableExists(table):
        return
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect()
    facts = {row["col_name"]: row["data_type"] for row in described}
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    ours = location.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(location)
    found = facts.get("Location")
    there = spark._jvm.org.apache.hadoop.fs.Path(found).toUri().getPath() if found else None
    if (
        facts.get("Type") != "EXTERNAL"
        or facts.get("Provider", "").lower() != "parquet"
        or there != ours.toUri().getPath()
    ):
        raise ValueError(f"{table} exists and is not the external Parquet table at {path}")


def register_partitions(
    spark: SparkSession, table: str, path: str, grain: Grain, gold: DataFrame, load_type: str
) -> None:
    """Create the external table if needed and make the written partitions known.

    Safe to repeat. A full load brings the entry in line with the directories, without taking the
    table away from its readers. An incremental load adds the partitions of the batch, at most one
    per bucket, the latest last. A table of that name that is not ours is refused.
    """
    check_owner(spark, table, path)
    name = quoted(table)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{column}` {kind}" for column, kind in gold.dtypes)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(grain.partitions)}) LOCATION '{place}'"
        )
        spark.catalog.recoverPartitions(table)
        return
    if load_type == FULL_LOAD:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        spark.catalog.refreshTable(table)
        return
    added = gold.select(*grain.partitions).distinct().orderBy(*grain.partitions).collect()
    for start in range(0, len(added), ADDED_PER_STATEMENT):
        specs = " ".join(
            f"PARTITION ({partition_spec(row.asDict())})"
            for row in added[start : start + ADDED_PER_STATEMENT]
        )
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(table)


def partition_spec(values: dict[str, int | None]) -> str:
    return ", ".join(
        f"{part}={'null' if value is None else value}" for part, value in values.items()
    )


def repair_registration(
    spark: SparkSession, table: str, grain: Grain, watermark: datetime
) -> None:
    """Register what an earlier run wrote but did not live to register.

    Partitions are added in ascending order, so it is enough to look for the latest one.
    """
    latest = partition_spec({part: getattr(watermark, part) for part in grain.partitions})
    if spark.sql(f"SHOW PARTITIONS {quoted(table)} PARTITION ({latest})").isEmpty():
        spark.catalog.recoverPartitions(table)
