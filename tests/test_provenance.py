import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from tripgrain.durable import scratch_path
from tripgrain.plans.provenance import PROVENANCE, in_partitions, partition_pairs, read_provenance, sources_of
from tripgrain.plans.refresh import refresh, samples_to_compute
from tripgrain.plans.statistics import driving_stat
from tripgrain.schema import DAY, HOUR
from tripgrain.sinks.gold import write_partitioned
from tripgrain.sources.positions import partitions_after
from tripgrain.sources.sample_tables import event_positions

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def source(spark):
    """Samples on disk, one in five stored a day after it was taken."""
    positions = event_positions(spark, SF_DIR)
    arrived = F.when(F.col("ct") % 3 == 0, F.date_add("ts", 1)).otherwise(F.to_date("ts"))
    shifted = positions.withColumns({"year": F.year(arrived), "month": F.month(arrived), "day": F.dayofmonth(arrived)})
    path = scratch_path(spark, "shifted")
    write_partitioned(shifted, DAY.partitions, path, "overwrite")
    return spark.read.parquet(path)


def rows_of(gold):
    """Rows as tuples; partition columns read back from directories have the narrowest type."""
    return sorted(map(tuple, gold.select(*[F.col(name).cast("string") for name in DAY.gold_columns]).collect()), key=repr)


def gold(spark, path):
    return rows_of(spark.read.parquet(path))


def test_touched_buckets_read_listed_directories_only(spark, source):
    target = scratch_path(spark, "gold-day")
    table = target.rsplit("/", 1)[1].replace("-", "_")
    cut = datetime(2024, 1, 10)
    early = source.filter(~partitions_after(DAY, cut))
    refresh(early, DAY, target, table)
    batch = source.filter(partitions_after(DAY, cut))
    plan = samples_to_compute(batch, source, partition_pairs(batch, DAY), DAY, target)
    scans = plan._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[(.*)", scans)
    assert filters and not any(found.startswith("]") for found in filters)
    again = spark.createDataFrame([(2024, 1, 10)], "gold_year int, gold_month int, gold_day int")
    listed = source.filter(sources_of(again, partition_pairs(batch, DAY), target, DAY))
    days = listed.select(*DAY.partitions).distinct().collect()
    assert sorted(map(tuple, days)) == [(2024, 1, 10), (2024, 1, 11)]
    refresh(source, DAY, target, table)
    expected = rows_of(driving_stat(source, DAY))
    assert gold(spark, target) == expected
    noted = read_provenance(spark, target, DAY).distinct()
    assert sorted(map(tuple, noted.collect())) == sorted(map(tuple, partition_pairs(source, DAY).collect()))
    spark.sql(f"DROP TABLE {table}")


def test_without_the_map_the_whole_source_is_read(spark, source):
    """A table of an earlier version has no map, and never gets an incomplete one."""
    target = scratch_path(spark, "gold-day")
    table = target.rsplit("/", 1)[1].replace("-", "_")
    refresh(source.filter(~partitions_after(DAY, datetime(2024, 1, 10))), DAY, target, table)
    noted = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{PROVENANCE}")
    files = noted.getFileSystem(spark._jsc.hadoopConfiguration())
    files.rename(noted, spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_gone"))
    refresh(source, DAY, target, table)
    expected = rows_of(driving_stat(source, DAY))
    assert gold(spark, target) == expected
    assert not files.exists(noted)
    spark.sql(f"DROP TABLE {table}")


def test_condition_on_partitions(spark):
    kind = "year int, month int, day int, hour int"
    rows = [(2024, 1, 1, 0), (2024, 1, 1, 5), (2024, 1, 2, 5), (2023, 1, 1, 5), (None, None, None, None), (2024, 1, 1, None)]
    frame = spark.createDataFrame(rows, kind)
    for listed in ([], rows[:1], rows[1:4], rows[4:], rows):
        found = frame.filter(in_partitions(HOUR, listed)).collect()
        assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, listed))
