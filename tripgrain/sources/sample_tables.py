"""Position samples projected from the `events` and `orders` tables, which hold no coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.schema import POSITION_COLUMNS


def _as_positions(
    rows: DataFrame, user: Column, ts: Column, number: Column, sp: Column
) -> DataFrame:
    return rows.select(
        (user % 4).alias("trip_id"),
        user.alias("user_id"),
        (user % 7).alias("vehicle_id"),
        ts.alias("ts"),
        (F.lit(35.0) + (number % 97) / F.lit(1000.0)).alias("latitude"),
        (F.lit(139.0) + (number % 89) / F.lit(1000.0)).alias("longitude"),
        number.alias("ct"),
        sp.alias("sp"),
    ).select(
        *POSITION_COLUMNS,
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.hour("ts").alias("hour"),
    )


def event_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of samples for the hour and day grains."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return _as_positions(
        events, F.col("user_id"), F.col("ts"), F.col("event_id"), F.col("value") % 120
    )


def order_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eighty months of samples for the month grain."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return _as_positions(
        orders,
        F.col("o_custkey"),
        F.col("o_orderdate"),
        F.col("o_orderkey"),
        F.round(F.col("o_totalprice") % 120, 2),
    )
