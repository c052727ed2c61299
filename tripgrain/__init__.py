"""Driving statistics from vehicle position samples, as Spark DataFrame plans."""

from tripgrain.plans.refresh import refresh
from tripgrain.plans.statistics import daily_stat, driving_stat, hourly_stat, monthly_stat
from tripgrain.schema import DAY, GRAINS, HOUR, MONTH

__all__ = [
    "DAY",
    "GRAINS",
    "HOUR",
    "MONTH",
    "daily_stat",
    "driving_stat",
    "hourly_stat",
    "monthly_stat",
    "refresh",
]
