"""Hourly, daily and monthly driving statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.functions.measures import driving_minutes, trip_averages
from tripgrain.functions.timestamps import with_bucket, year_month
from tripgrain.operators.rollup import bucket_rollup, month_rollup
from tripgrain.operators.trips import Motion, trip_rows
from tripgrain.schema import DAY, HOUR, MONTH, POSITION_COLUMNS, Grain, check_positions


def position_samples(positions: DataFrame, grain: Grain) -> DataFrame:
    """The eight sample columns with the bucket of the grain; partition columns are dropped."""
    check_positions(positions)
    return with_bucket(positions.select(*POSITION_COLUMNS), grain)


def finish_buckets(buckets: DataFrame, grain: Grain) -> DataFrame:
    """Bucket totals to the gold layout: minutes, calendar columns and averages."""
    calendar = {"year": F.year("date"), "month": F.month("date"), "day": F.dayofmonth("date")}
    needed = set(grain.gold_columns) - set(buckets.columns)
    missing = {part: calendar[part] for part in calendar if part in needed}
    minutes = {"total_driving_time": driving_minutes(F.col("total_driving_time"))}
    complete = buckets.withColumns({**missing, **minutes}).withColumns(
        {"year_month": year_month(F.col("year"), F.col("month")), **trip_averages(grain)}
    )
    return complete.select(*grain.gold_columns)


def driving_stat(
    positions: DataFrame,
    grain: Grain,
    max_group_rows: int | None = None,
    formulas: Motion | None = None,
) -> DataFrame:
    """The gold table of a grain, one row per bucket, by our formulas or by given ones."""
    trips = trip_rows(position_samples(positions, grain), grain, max_group_rows, formulas)
    return finish_buckets(bucket_rollup(trips, grain), grain)


def hourly_stat(
    positions: DataFrame, max_group_rows: int | None = None, formulas: Motion | None = None
) -> DataFrame:
    """One row per date and hour."""
    return driving_stat(positions, HOUR, max_group_rows, formulas)


def daily_stat(
    positions: DataFrame, max_group_rows: int | None = None, formulas: Motion | None = None
) -> DataFrame:
    """One row per date."""
    return driving_stat(positions, DAY, max_group_rows, formulas)


def monthly_stat(
    positions: DataFrame,
    collapse: bool = False,
    max_group_rows: int | None = None,
    formulas: Motion | None = None,
) -> DataFrame:
    """One row per date in the month layout, or one per month with `collapse`."""
    if not collapse:
        return driving_stat(positions, MONTH, max_group_rows, formulas)
    trips = trip_rows(position_samples(positions, MONTH), MONTH, max_group_rows, formulas)
    return finish_buckets(month_rollup(trips, MONTH), MONTH)
