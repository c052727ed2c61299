"""Distance, harsh events and the statistics as functions that SQL can call."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tripgrain.functions.motion import EARTH_RADIUS_M, HARSH_CHANGE, STOP_SPEED
from tripgrain.schema import EVENT_COUNTS, GRAINS

# The classes in the order of `EVENT_COUNTS`, named after them.
EVENT_NAMES = [name.removeprefix("total_").removesuffix("_count") for name in EVENT_COUNTS]

_POINTS = ", ".join(f"{name} DOUBLE" for name in ("lat1", "lon1", "lat2", "lon2"))


def _haversine_sql() -> str:
    across = "cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2.0)"
    chord = f"pow(sin(radians(lat2 - lat1) / 2), 2.0) + {across}"
    return f"""CASE WHEN lat1 IS NULL OR lon1 IS NULL OR lat2 IS NULL OR lon2 IS NULL THEN 0.0D
        ELSE 2 * {EARTH_RADIUS_M}D * asin(sqrt(least(1.0D, {chord}))) END"""


def _event_sql() -> str:
    start, stop, faster, slower = EVENT_NAMES
    return f"""CASE
        WHEN change >= harsh AND sp1 <= stop_speed THEN '{start}'
        WHEN change <= -harsh AND sp2 <= stop_speed THEN '{stop}'
        WHEN change >= harsh AND sp1 > stop_speed THEN '{faster}'
        WHEN change <= -harsh AND sp2 > stop_speed THEN '{slower}' END"""


def register_functions(spark: SparkSession) -> None:
    """Make these callable from SQL in this session; safe to repeat.

    * `haversine_m(lat1, lon1, lat2, lon2)`: metres, 0 where a coordinate is NULL.
    * `speed_change(ct1, sp1, ct2, sp2)`: change of speed per unit of `ct`, NULL without progress.
    * `harsh_event(sp1, sp2, change[, stop_speed, harsh])`: the class of a step, NULL for none.

    They are SQL expressions that Spark puts in place of the call, so nothing leaves its generated
    code.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION haversine_m({_POINTS}) "
        f"RETURNS DOUBLE RETURN {_haversine_sql()}"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION speed_change"
        "(ct1 BIGINT, sp1 DOUBLE, ct2 BIGINT, sp2 DOUBLE) RETURNS DOUBLE "
        "RETURN CASE WHEN ct2 > ct1 THEN try_divide(sp2 - sp1, CAST(ct2 - ct1 AS DOUBLE)) END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION harsh_event"
        f"(sp1 DOUBLE, sp2 DOUBLE, change DOUBLE, stop_speed DOUBLE DEFAULT {STOP_SPEED}D, "
        f"harsh DOUBLE DEFAULT {HARSH_CHANGE}D) RETURNS STRING RETURN {_event_sql()}"
    )


def trip_motion_sql(source: str, grain_name: str) -> str:
    """SQL for distance and events of every trip, by the functions alone.

    `source` is a table or view of position samples. Each sample is compared with the one before it
    in the trip, and each known position with the last known one.
    """
    grain = GRAINS[grain_name]
    parts = {"hour": "hour(ts)", "day": "day(ts)", "month": "month(ts)"}
    keys = ", ".join(grain.trip_keys)
    order = f"PARTITION BY {keys} ORDER BY ct, ts, latitude, longitude, sp"
    before = f"{order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    events = ", ".join(
        f"count_if(event = '{event}') AS {name}" for event, name in zip(EVENT_NAMES, EVENT_COUNTS)
    )
    finite = "abs({0}) < DOUBLE('infinity')"
    located = " AND ".join(finite.format(f"CAST({name} AS DOUBLE)") for name in ("latitude", "longitude"))
    speed = f"CASE WHEN {finite.format('CAST(sp AS DOUBLE)')} THEN round(CAST(sp AS DOUBLE), 2) END"
    return f"""
        WITH samples AS (
            SELECT to_date(ts) AS date, {parts[grain.name]} AS {grain.name}, trip_id, ct, ts,
                   CASE WHEN {located} THEN CAST(latitude AS DOUBLE) END AS latitude,
                   CASE WHEN {located} THEN CAST(longitude AS DOUBLE) END AS longitude,
                   {speed} AS sp
            FROM {source}),
        stepped AS (
            SELECT *, lag(ct) OVER ({order}) AS ct1, lag(sp) OVER ({order}) AS sp1,
                   last_value(latitude) IGNORE NULLS OVER ({before}) AS lat1,
                   last_value(longitude) IGNORE NULLS OVER ({before}) AS lon1
            FROM samples),
        steps AS (
            SELECT {keys}, haversine_m(lat1, lon1, latitude, longitude) AS metres,
                   harsh_event(sp1, sp, speed_change(ct1, sp1, ct, sp)) AS event
            FROM stepped)
        SELECT {keys}, CAST(round(sum(metres)) AS BIGINT) AS total_distance, {events}
        FROM steps GROUP BY {keys}"""
