from datetime import datetime
from pathlib import Path

import pytest
from tripgrain.durable import scratch_path
from tripgrain.schema import DAY, GRAINS, HOUR, MONTH
from tripgrain.sinks.gold import write_partitioned
from tripgrain.sources.listing import latest_listed, latest_partition_listed
from tripgrain.sources.positions import latest_partition, watermark_of

KIND = "year int, month int, day int, hour int, n int"
ROWS = [
    (2023, 12, 31, 23, 1),
    (2024, 2, 9, 10, 2),
    (2024, 10, 1, 9, 3),
    (2024, 10, 1, 11, 4),
    (2024, 10, None, 12, 5),
    (2025, None, 1, 1, 6),
    (None, 12, 31, 23, 7),
]


def written(spark, rows, grain):
    path = scratch_path(spark, "listed").removeprefix("file:")
    write_partitioned(spark.createDataFrame(rows, KIND), grain.partitions, path, "overwrite")
    return path


def same(spark, path, grain):
    expected = latest_partition(spark.read.schema(KIND).parquet(path), grain).collect()
    assert latest_partition_listed(spark, path, grain).collect() == expected
    return expected[0]["latest_ts"]


@pytest.mark.parametrize("grain", GRAINS.values(), ids=GRAINS)
def test_equal_to_the_scan(spark, grain):
    path = written(spark, ROWS, grain)
    assert same(spark, path, grain) == latest_listed(spark, path, grain) == watermark_of(spark, path, grain)


@pytest.mark.parametrize("grain", GRAINS.values(), ids=GRAINS)
def test_only_null_partitions_or_no_rows(spark, grain):
    nulls = [(None, None, None, None, 1), (2024, None, 1, 1, 2)]
    assert same(spark, written(spark, nulls, grain), grain) is None
    assert latest_listed(spark, written(spark, [], grain), grain) is None
    assert latest_listed(spark, scratch_path(spark, "nowhere"), grain) is None


def test_directories_without_files_are_passed_over(spark):
    path = written(spark, ROWS, HOUR)
    for empty in ("year=2026", "year=2025/month=3/day=1/hour=1", "year=2024/month=11", "year=2024/month=10/day=30"):
        (Path(path) / empty).mkdir(parents=True)
    hidden = Path(path) / "year=2027/month=1/day=1/hour=1"
    hidden.mkdir(parents=True)
    (hidden / "_started").write_text("x")
    (hidden / ".part.crc").write_text("x")
    for beside in ("_consumed", "other=9999", "year=x"):
        (Path(path) / beside).mkdir()
    assert latest_listed(spark, path, HOUR) == datetime(2024, 10, 1, 11)


def test_padded_names_are_numbers(spark):
    path = written(spark, [(2024, 10, 1, 1, 1)], DAY)
    padded = Path(path) / "year=2024/month=09/day=07"
    padded.mkdir(parents=True)
    assert latest_listed(spark, path, DAY) == datetime(2024, 10, 1)
    (padded / "part-0.parquet").write_bytes(b"x")
    (Path(path) / "year=2024/month=10").rename(Path(path) / "_gone")
    # The file is no Parquet: its name is all that is looked at.
    assert latest_listed(spark, path, DAY) == datetime(2024, 9, 7)


def test_no_job_runs(spark):
    path, jobs = written(spark, ROWS, MONTH), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        assert watermark_of(spark, path, MONTH) == datetime(2024, 10, 1)
        assert not jobs.getJobIdsForGroup("listing")
        spark.read.parquet(path).count()
        assert jobs.getJobIdsForGroup("listing")
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")
