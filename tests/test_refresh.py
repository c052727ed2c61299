import shutil
import uuid
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import refresh_job
from fixtures import START, frame, mixed_samples, sample
from tripgrain import refresh
from tripgrain.functions.timestamps import with_time_columns
from tripgrain.plans.refresh import resolve_load_type
from tripgrain.plans.statistics import driving_stat
from tripgrain.schema import DAY, GRAINS, HOUR, MONTH
from tripgrain.sinks.gold import (
    FULL_LOAD,
    INCREMENTAL,
    partition_paths,
    register_partitions,
    target_exists,
    write_gold,
    write_partitioned,
)
from tripgrain.sources.positions import (
    incremental,
    latest_partition,
    latest_partition_sql,
    partitions_after,
    read_positions,
    watermark_of,
)


@pytest.fixture
def target(spark, tmp_path):
    table = f"gold_{uuid.uuid4().hex}"
    yield str(tmp_path / "gold"), table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def silver(spark, samples):
    return with_time_columns(frame(spark, samples)).drop("date")


def ordered(df, grain):
    return sorted(df.select(*grain.gold_columns).collect(), key=repr)


def partitions(spark, table):
    return sorted(row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect())


def test_unknown_load_type_is_refused(spark, target):
    path, table = target
    with pytest.raises(ValueError):
        refresh(silver(spark, [sample()]), HOUR, path, table, "X")


def test_incremental_without_history_is_a_full_load(spark, target):
    path, table = target
    assert resolve_load_type(spark, INCREMENTAL, table, path) == FULL_LOAD
    assert refresh(silver(spark, [sample()]), HOUR, path, table) == FULL_LOAD
    assert target_exists(spark, table, path)
    assert resolve_load_type(spark, INCREMENTAL, table, path) == INCREMENTAL
    assert not target_exists(spark, table, path + "-elsewhere")


@pytest.mark.parametrize("grain", GRAINS.values(), ids=GRAINS)
def test_two_loads_equal_one(spark, target, grain):
    path, table = target
    days = [
        sample(trip=trip, ts=START + timedelta(days=20 * n, hours=n), ct=n)
        for n in range(6)
        for trip in "ab"
    ]
    early, everything = silver(spark, days[:6]), silver(spark, days)
    assert refresh(early, grain, path, table, FULL_LOAD) == FULL_LOAD
    assert refresh(everything, grain, path, table) == INCREMENTAL
    assert refresh(everything, grain, path, table) is None
    expected = ordered(driving_stat(everything, grain), grain)
    assert ordered(spark.read.parquet(path), grain) == expected
    assert ordered(spark.table(table), grain) == expected


def test_late_samples_of_a_written_bucket_stay_out(spark, target):
    path, table = target
    refresh(silver(spark, [sample()]), HOUR, path, table)
    late = silver(spark, [sample(), sample(trip="late"), sample(ts=START - timedelta(hours=1))])
    assert refresh(late, HOUR, path, table) is None
    assert spark.table(table).count() == 1


def test_full_load_replaces_the_table(spark, target):
    path, table = target
    refresh(silver(spark, [sample()]), DAY, path, table, FULL_LOAD)
    moved = silver(spark, [sample(ts=START + timedelta(days=1))])
    refresh(moved, DAY, path, table, FULL_LOAD)
    assert partitions(spark, table) == ["year=2024/month=1/day=6"]


def test_unregistered_partitions_are_found_again(spark, target):
    path, table = target
    days = [sample(ts=START + timedelta(days=n)) for n in range(4)]
    refresh(silver(spark, days[:1]), DAY, path, table)
    # A run that wrote its batch and was lost before registering it.
    write_gold(driving_stat(silver(spark, days[1:3]), DAY), DAY, path, INCREMENTAL)
    assert spark.table(table).count() == 1
    assert refresh(silver(spark, days[:3]), DAY, path, table) == INCREMENTAL
    assert refresh(silver(spark, days[:3]), DAY, path, table) is None
    assert len(partitions(spark, table)) == spark.table(table).count() == 3
    refresh(silver(spark, days), DAY, path, table)
    assert len(partitions(spark, table)) == spark.table(table).count() == 4


def test_full_load_lost_before_writing_is_done_again(spark, target):
    path, table = target
    refresh(silver(spark, [sample()]), DAY, path, table)
    shutil.rmtree(path)
    Path(path).mkdir()
    assert watermark_of(spark, path, DAY) is None
    assert refresh(silver(spark, [sample()]), DAY, path, table) == FULL_LOAD
    assert spark.table(table).count() == 1


def test_month_with_unknown_dates(spark, target):
    path, table = target
    unknown = silver(spark, [sample(ts=None)]).withColumns(
        {"year": F.lit(2024), "month": F.lit(2)}
    )
    refresh(silver(spark, [sample()]), MONTH, path, table)
    gold = driving_stat(unknown, MONTH)
    assert refresh(unknown, MONTH, path, table) == INCREMENTAL
    assert refresh(unknown, MONTH, path, table) is None
    directory = "__HIVE_DEFAULT_PARTITION__"
    assert partitions(spark, table) == ["year=2024/month=1", f"year={directory}/month={directory}"]
    assert spark.table(table).count() == 2
    assert partition_paths(gold, MONTH).first()[0] == f"year={directory}/month={directory}/"
    assert watermark_of(spark, path, MONTH) == datetime(2024, 1, 1)


def source_day(df, day):
    return df.withColumns({"day": F.lit(day)})


def test_samples_in_a_later_source_partition(spark, target):
    path, table = target
    first = source_day(silver(spark, [sample(ct=1), sample(trip="b", ct=1)]), 5)
    late = source_day(silver(spark, [sample(ct=9, lat=36.0), sample(trip="c", ct=3)]), 6)
    everything = first.unionByName(late)
    refresh(first, DAY, path, table)
    expected = ordered(driving_stat(everything, DAY), DAY)
    assert refresh(everything, DAY, path, table) == INCREMENTAL
    for _ in range(2):
        assert refresh(everything, DAY, path, table) is None
        assert ordered(spark.read.parquet(path), DAY) == ordered(spark.table(table), DAY) == expected


def test_a_partly_written_batch_is_completed(spark, target):
    path, table = target
    days = [sample(ts=START + timedelta(days=n)) for n in range(4)]
    refresh(silver(spark, days[:1]), DAY, path, table)
    write_gold(driving_stat(silver(spark, days[2:3]), DAY), DAY, path, INCREMENTAL)
    everything = silver(spark, days)
    assert refresh(everything, DAY, path, table) == INCREMENTAL
    assert refresh(everything, DAY, path, table) is None
    assert ordered(spark.table(table), DAY) == ordered(driving_stat(everything, DAY), DAY)


def test_written_buckets_are_repaired_on_demand(spark, target):
    path, table = target
    days = [sample(ts=START + timedelta(days=n)) for n in range(3)]
    refresh(silver(spark, days), DAY, path, table)
    late = silver(spark, [*days, sample(trip="late", ts=START + timedelta(days=1))])
    assert refresh(late, DAY, path, table) is None
    again = refresh(late, DAY, path, table, repair_from=START + timedelta(days=1))
    assert again == INCREMENTAL
    assert ordered(spark.table(table), DAY) == ordered(driving_stat(late, DAY), DAY)
    assert refresh(late, DAY, path, table) is None


def test_foreign_tables_are_refused(spark, target, tmp_path):
    path, table = target
    spark.range(3).write.saveAsTable(table)
    for load_type in (FULL_LOAD, INCREMENTAL):
        with pytest.raises(ValueError, match="exists"):
            refresh(silver(spark, [sample()]), DAY, path, table, load_type)
    assert spark.table(table).count() == 3 and not Path(path).exists()
    spark.sql(f"DROP TABLE {table}")
    refresh(silver(spark, [sample()]), DAY, f"{path}-other", table)
    with pytest.raises(ValueError, match="exists"):
        refresh(silver(spark, [sample()]), DAY, path, table, FULL_LOAD)


def test_paths_with_quotes(spark, target):
    path, table = target
    odd = f"{path} of o'clock"
    refresh(silver(spark, [sample()]), DAY, odd, table, FULL_LOAD)
    refresh(silver(spark, [sample()]), DAY, odd, table, FULL_LOAD)
    assert spark.table(table).count() == 1


def test_registration_is_repeatable(spark, target):
    path, table = target
    gold = driving_stat(silver(spark, mixed_samples(rows=200)), HOUR)
    write_gold(gold, HOUR, path, FULL_LOAD)
    for load_type in (FULL_LOAD, INCREMENTAL, INCREMENTAL):
        register_partitions(spark, table, path, HOUR, gold, load_type)
    listed = {row[0] for row in partition_paths(gold, HOUR).collect()}
    assert {f"{name}/" for name in partitions(spark, table)} == listed


@pytest.mark.parametrize("grain", GRAINS.values(), ids=GRAINS)
def test_latest_partition_by_expression_and_by_sql(spark, grain):
    stamps = [datetime(2023, 12, 31, 23), datetime(2024, 2, 1, 3), datetime(2024, 1, 31, 9), None]
    table = silver(spark, [sample(ts=ts) for ts in stamps])
    expected = datetime(2024, 2, 1, 3 if grain is HOUR else 0)
    for latest in (latest_partition, latest_partition_sql):
        row = latest(table, grain).first()
        assert row["latest_ts"] == expected
        assert [row[part] for part in grain.partitions] == [
            getattr(expected, part) for part in grain.partitions
        ]


def test_partitions_after_compares_part_by_part(spark):
    watermark = datetime(2024, 1, 15, 12)
    stamps = [
        datetime(2023, 12, 31, 23),
        datetime(2024, 1, 14, 23),
        datetime(2024, 1, 15, 11),
        watermark,
        datetime(2024, 1, 15, 13),
        datetime(2024, 1, 16, 0),
        datetime(2024, 2, 1, 0),
        datetime(2025, 1, 1, 0),
    ]
    positions = silver(spark, [sample(ts=ts) for ts in stamps])
    for grain, later in ((HOUR, 4), (DAY, 3), (MONTH, 2)):
        kept = positions.filter(partitions_after(grain, watermark)).collect()
        assert sorted(row["ts"] for row in kept) == stamps[-later:]


def test_incremental_scan_skips_directories(spark, tmp_path):
    path = str(tmp_path / "silver")
    samples = [sample(ts=START + timedelta(days=n)) for n in range(5)]
    write_partitioned(silver(spark, samples), DAY.partitions, path, "overwrite")
    assert read_positions(spark, path, DAY).count() == 5
    later = read_positions(spark, path, DAY, START + timedelta(days=2))
    assert later.count() == 2 and len(later.inputFiles()) == 5
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "DataFilters: []" in plan
    pruned = incremental(spark.read.parquet(path), DAY, START + timedelta(days=2))
    scan = pruned.select(F.input_file_name()).distinct()
    assert scan.count() == 2


def test_partition_paths_do_not_compute_the_measures(spark, tmp_path):
    path = str(tmp_path / "positions")
    frame(spark, [sample()]).write.parquet(path)
    paths = partition_paths(driving_stat(spark.read.parquet(path), HOUR), HOUR)
    plan = paths._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<trip_id:string,ts:timestamp_ntz>" in plan
    assert [row[0] for row in paths.collect()] == ["year=2024/month=1/day=5/hour=10/"]


def test_command_line(spark, target, tmp_path, capsys):
    path, table = target
    source = str(tmp_path / "silver")
    days = [sample(ts=START + timedelta(days=n)) for n in range(2)]
    arguments = ["--grain", "day", "--source", source, "--target", path, "--table", table]
    for day in days:
        write_partitioned(silver(spark, [day]), DAY.partitions, source, "append")
        refresh_job.main(arguments)
    refresh_job.main(arguments)
    assert capsys.readouterr().out.split("\n")[:3] == [
        f"{table}: FULL_LOAD", f"{table}: INCREMENTAL", f"{table}: nothing new"
    ]
    refresh_job.main([*arguments, "--repair-from", "2024-01-05", "--harsh", "3"])
    assert capsys.readouterr().out == f"{table}: INCREMENTAL\n"
    with pytest.raises(ValueError):
        refresh_job.main([*arguments, "--load-type", "X"])
