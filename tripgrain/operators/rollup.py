"""Roll trip rows up into one row per time bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.schema import Grain


def bucket_rollup(trips: DataFrame, grain: Grain) -> DataFrame:
    """Number of trips and sums of their measures per bucket.

    Trip rows are unique per bucket and trip, so counting the known trip ids is an exact distinct
    count. `user_count` and `vehicle_count` add up the distinct counts of the trips.
    """
    return trips.groupBy(*grain.bucket_keys).agg(
        F.count("trip_id").alias("trip_count"),
        *[F.sum(total).alias(total) for total in grain.trip_totals],
    )


def month_rollup(trips: DataFrame, grain: Grain) -> DataFrame:
    """The same per calendar month: a trip seen on several dates counts once."""
    return trips.groupBy(F.year("date").alias("year"), "month").agg(
        F.count_distinct("trip_id").alias("trip_count"),
        *[F.sum(total).alias(total) for total in grain.trip_totals],
    )
