"""Measures taken from totals: whole units, minutes and per-trip averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripgrain.schema import Grain


def whole(value: Column) -> Column:
    """Half-up to a whole number."""
    return F.round(value).cast("long")


def driving_minutes(seconds: Column) -> Column:
    return whole(F.try_divide(seconds.cast("double"), F.lit(60.0)))


def trip_averages(grain: Grain) -> dict[str, Column]:
    """Totals divided by the trip count; NULL for a bucket without trips."""
    trips = F.col("trip_count").cast("double")
    return {
        average: F.try_divide(F.col(total).cast("double"), trips)
        for average, total in grain.averaged.items()
    }
