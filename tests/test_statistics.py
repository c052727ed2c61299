import re
from datetime import date, datetime, timedelta

import pytest

from fixtures import SCHEMA, START, frame, sample
from tripgrain import daily_stat, hourly_stat, monthly_stat
from tripgrain.schema import DAY, HOUR, MONTH


def test_columns_in_gold_order(spark):
    positions = frame(spark, [sample()])
    events = ["sudden_start_count", "sudden_stop_count", "acceleration_count", "deceleration_count"]
    totals = ["trip_count", "user_count", "vehicle_count", "total_driving_time", "total_distance"]
    measured = totals + [f"total_{name}" for name in events]
    averages = ["avg_distance", "avg_driving_time"] + [f"avg_{name}" for name in events]
    assert hourly_stat(positions).columns == [
        "date", "hour", *measured, "year", "month", "day", *averages
    ]
    assert daily_stat(positions).columns == [
        "date", "day", *measured, "year", "month", *averages, "year_month"
    ]
    monthly = ["year_month", "month", *totals, "year", "avg_distance"]
    assert monthly_stat(positions).columns == monthly
    assert monthly_stat(positions, collapse=True).columns == monthly
    kinds = dict(hourly_stat(positions).dtypes)
    assert kinds["date"] == "date" and kinds["hour"] == kinds["year"] == "int"
    assert all(kinds[name] == "bigint" for name in measured)
    assert all(kinds[name] == "double" for name in averages)


@pytest.mark.parametrize("seconds, minutes", [(29, 0), (30, 1), (89, 1), (90, 2)])
def test_driving_minutes_round_half_up(spark, seconds, minutes):
    positions = frame(spark, [sample(ct=n) for n in range(seconds)])
    assert hourly_stat(positions).first()["total_driving_time"] == minutes


def test_minutes_are_rounded_after_summing(spark):
    trips = [sample(trip=trip, ct=n) for trip in "ab" for n in range(45)]
    row = daily_stat(frame(spark, trips)).first()
    assert row["total_driving_time"] == 2 and row["avg_driving_time"] == 1.0


def test_users_are_counted_once_per_trip(spark):
    trips = [sample(trip=trip, user=1, vehicle=vehicle) for trip, vehicle in zip("abb", (1, 1, 2))]
    row = daily_stat(frame(spark, trips)).first()
    assert (row["trip_count"], row["user_count"], row["vehicle_count"]) == (2, 2, 3)


def test_null_trips_and_times_stay_only_in_the_month(spark):
    unknown = [sample(trip=None), sample(ts=None)]
    positions = frame(spark, unknown)
    assert hourly_stat(positions).count() == daily_stat(positions).count() == 0
    rows = {row["year_month"]: row for row in monthly_stat(positions).collect()}
    assert rows.keys() == {"20241", None}
    assert (rows["20241"]["trip_count"], rows["20241"]["avg_distance"]) == (0, None)
    assert rows[None]["trip_count"] == 1


def test_unreadable_text_counts_as_no_time(spark):
    schema = SCHEMA.replace("timestamp_ntz", "string")
    positions = frame(spark, [sample(ts="2024-01-05 10:00:00"), sample(ts="yesterday")], schema)
    assert hourly_stat(positions).first()["date"] == date(2024, 1, 5)
    assert hourly_stat(positions).count() == 1 and monthly_stat(positions).count() == 2


def test_month_layout_by_date_or_collapsed(spark):
    samples = [
        sample(trip=trip, ts=START + timedelta(days=day), ct=n, lat=35.0 + n)
        for trip, day in (("a", 0), ("a", 1), ("b", 1), ("a", 40))
        for n in (0, 1)
    ]
    positions = frame(spark, samples)
    by_date = sorted((row["month"], row["trip_count"]) for row in monthly_stat(positions).collect())
    assert by_date == [(1, 1), (1, 2), (2, 1)]
    months = monthly_stat(positions, collapse=True).orderBy("month").collect()
    january, february = months
    assert (january["year_month"], january["trip_count"]) == ("20241", 2)
    assert january["total_distance"] == 3 * 111_195
    assert january["avg_distance"] == 3 * 111_195 / 2
    assert (february["year_month"], february["trip_count"]) == ("20242", 1)


def test_ids_may_be_text_or_numbers(spark):
    numbered = SCHEMA.replace("trip_id string", "trip_id long")
    as_text = hourly_stat(frame(spark, [sample(trip="7")]))
    assert as_text.collect() == hourly_stat(frame(spark, [sample(trip=7)], numbered)).collect()


def test_tables_of_another_shape_are_refused(spark):
    positions = frame(spark, [sample()])
    with pytest.raises(ValueError, match="sp is missing"):
        hourly_stat(positions.drop("sp"))
    with pytest.raises(ValueError, match="ct is string"):
        hourly_stat(positions.withColumn("ct", positions["ct"].cast("string")))


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_plans_shuffle_once_per_level(spark, tmp_path):
    path = str(tmp_path / "positions")
    frame(spark, [sample()]).write.parquet(path)
    positions = spark.read.parquet(path)
    for stat in (hourly_stat, daily_stat, monthly_stat):
        plan = stat(positions)._jdf.queryExecution().executedPlan().toString()
        assert exchanges(stat(positions)) == 2
        assert plan.count("Sort [") == 1 and "Python" not in plan
        assert plan.count("FileScan") == 1
        scanned = re.search(r"FileScan parquet \[(.*?)\]", plan)[1]
        assert ("sp#" in scanned) == (stat is not monthly_stat)


def test_text_times_are_parsed_once(spark, tmp_path):
    path = str(tmp_path / "positions")
    schema = SCHEMA.replace("timestamp_ntz", "string")
    frame(spark, [sample(ts="2024-01-05 10:00:00")], schema).write.parquet(path)
    plan = hourly_stat(spark.read.parquet(path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") == 2 and plan.count("regexp_extract") == 1
    assert "isnotnull(trip_id" in plan


def test_hot_trips_are_split_without_whole_group_windows(spark):
    samples = [sample(trip="hot", ct=n, ts=START + timedelta(seconds=n)) for n in range(400)]
    split = daily_stat(frame(spark, samples), max_group_rows=50)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "BroadcastHashJoin" in plan
    assert split.collect() == daily_stat(frame(spark, samples)).collect()


def test_grain_tables_agree():
    assert HOUR.trip_keys == ["date", "hour", "trip_id"]
    assert DAY.partitions == ("year", "month", "day")
    assert MONTH.averaged == {"avg_distance": "total_distance"}
    assert datetime(2024, 1, 5, 10) == START
