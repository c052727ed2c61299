"""Which source partitions the buckets of a gold table were computed from.

A many-to-many map beside the gold partitions, as event time and source time may differ. A refresh
that reaches into a bucket again reads the listed source directories instead of all of them.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.functions.timestamps import with_bucket
from tripgrain.schema import Grain

PROVENANCE = "_provenance"
# A longer list of directories is no cheaper to plan than a scan, and is not fetched.
MAX_LISTED = 2000


def by_gold_partition(positions: DataFrame, grain: Grain) -> DataFrame:
    """Samples with the gold partition they belong to as `gold_year`, …"""
    dated = with_bucket(positions, grain)
    parts = {
        "year": F.year("date"),
        "month": F.month("date"),
        "day": F.dayofmonth("date"),
        "hour": F.hour("ts"),
    }
    return dated.withColumns({f"gold_{name}": parts[name] for name in grain.partitions})


def gold_names(grain: Grain) -> list[str]:
    return [f"gold_{name}" for name in grain.partitions]


def source_names(grain: Grain) -> list[str]:
    return [f"source_{name}" for name in grain.partitions]


def partition_pairs(positions: DataFrame, grain: Grain) -> DataFrame:
    """Each source partition with each gold partition that its samples belong to."""
    # The bucket's columns take the place of source columns of their names.
    kept = positions.withColumns(dict(zip(source_names(grain), map(F.col, grain.partitions))))
    return by_gold_partition(kept, grain).select(*source_names(grain), *gold_names(grain)).distinct()


def source_partitions(pairs: DataFrame, grain: Grain) -> DataFrame:
    """The source partitions of pairs under the names they have in the source."""
    return pairs.select(*source_names(grain)).toDF(*grain.partitions)


def has_provenance(spark: SparkSession, path: str) -> bool:
    noted = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{PROVENANCE}")
    return noted.getFileSystem(spark._jsc.hadoopConfiguration()).exists(noted)


def note_provenance(pairs: DataFrame, path: str) -> None:
    """Add pairs to the map. Repeated pairs do no harm; a full overwrite of the table removes it."""
    kinds = [F.col(name).cast("int") for name in pairs.columns]
    pairs.select(*kinds).write.mode("append").parquet(f"{path}/{PROVENANCE}")


def read_provenance(spark: SparkSession, path: str, grain: Grain) -> DataFrame:
    kinds = ", ".join(f"{name} int" for name in [*source_names(grain), *gold_names(grain)])
    return spark.read.schema(kinds).parquet(f"{path}/{PROVENANCE}")


def same_partition(one: DataFrame, other: DataFrame, names: list[str]) -> Column:
    return reduce(and_, [one[name].eqNullSafe(other[name]) for name in names])


def in_partitions(grain: Grain, partitions: list[tuple[int | None, ...]]) -> Column:
    """True in the listed source partitions, as comparisons of partition columns with constants."""
    finest: dict[tuple[int | None, ...], list[int | None]] = {}
    for *coarse, last in partitions:
        finest.setdefault(tuple(coarse), []).append(last)

    def equals(name: str, value: int | None) -> Column:
        return F.col(name).isNull() if value is None else F.col(name) == value

    def among(name: str, values: list[int | None]) -> Column:
        known = [value for value in values if value is not None]
        tests = [F.col(name).isin(known)] if known else []
        return reduce(or_, tests + [F.col(name).isNull()] * (None in values))

    *outer, inner = grain.partitions
    tests = [
        reduce(and_, [*map(equals, outer, coarse), among(inner, values)])
        for coarse, values in sorted(finest.items(), key=repr)
    ]
    return reduce(or_, tests, F.lit(False))


def sources_of(
    buckets: DataFrame, pairs: DataFrame, path: str, grain: Grain
) -> Column | None:
    """Condition on the source partitions that gold partitions come from, by the map and `pairs`.

    None if the table has no map, or if they are too many to list.
    """
    spark = buckets.sparkSession
    if not has_provenance(spark, path):
        return None
    known = read_provenance(spark, path, grain).unionByName(pairs)
    feeding = known.join(buckets, same_partition(known, buckets, gold_names(grain)), "left_semi")
    listed = source_partitions(feeding, grain).distinct().limit(MAX_LISTED + 1).collect()
    if len(listed) > MAX_LISTED:
        return None
    return in_partitions(grain, [tuple(row) for row in listed])
