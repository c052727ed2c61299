"""Trip rows: counts, distance and harsh-driving events of each trip in each time bucket."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgrain.functions.measures import whole
from tripgrain.functions.motion import (
    HARSH_CHANGE,
    STOP_SPEED,
    harsh_events,
    haversine_m,
    motion_inputs,
    speed_change,
)
from tripgrain.operators.skew import HotGroups, by_group_size, ordered_samples, with_tiles
from tripgrain.schema import EVENT_COUNTS, PATH_ORDER, SAMPLE_ORDER, Grain

DISTANCE = "distance_m"


def trip_agg(samples: DataFrame, keys: list[str]) -> DataFrame:
    """Users, vehicles, driving seconds and number of latitudes per trip.

    Samples are first reduced to one row per trip, user and vehicle, before and after the shuffle,
    so that neither a hot trip nor its set of users has to fit in one task.
    """
    pairs = samples.groupBy(*keys, "user_id", "vehicle_id").agg(
        F.count("ct").alias("seconds"), F.count("latitude").alias("latitudes")
    )
    trips = pairs.groupBy(*reversed(keys)).agg(
        F.count_distinct("user_id").alias("user_count"),
        F.count_distinct("vehicle_id").alias("vehicle_count"),
        F.sum("seconds").alias("total_driving_time"),
        F.sum("latitudes").alias("size_of_latitude"),
    )
    # Grouped in the key order of `ordered_samples`, so that a join with events need not shuffle.
    return trips.select(*keys, *trips.columns[len(keys) :])


@dataclass(frozen=True)
class Motion:
    """Which measures to take of the steps between samples, and by which formulas.

    `step_distance` gives the metres between two points (latitude and longitude of both, each
    NULL where unknown); a step without a known start has to give 0.
    """

    distance: bool = True
    events: bool = True
    stop_speed: float = STOP_SPEED
    harsh: float = HARSH_CHANGE
    step_distance: Callable[[Column, Column, Column, Column], Column] = haversine_m

    @property
    def measures(self) -> list[str]:
        return [DISTANCE] * self.distance + EVENT_COUNTS * self.events

    @property
    def order(self) -> list[str]:
        return SAMPLE_ORDER if self.events else PATH_ORDER

    def inputs(self, samples: DataFrame) -> DataFrame:
        return samples.withColumns(motion_inputs())

    def measure(self, steps: DataFrame, prefix: str = "") -> DataFrame:
        """Add the measures of the step from `lat1, lon1, ct1, sp1` to `lat2, lon2, ct2, sp2`."""
        lat1, lon1, ct1, sp1 = (F.col(name) for name in ("lat1", "lon1", "ct1", "sp1"))
        lat2, lon2, ct2, sp2 = (F.col(name) for name in ("lat2", "lon2", "ct2", "sp2"))
        measures = {}
        if self.distance:
            measures[DISTANCE] = self.step_distance(lat1, lon1, lat2, lon2)
        if self.events:
            # A column of its own, so that the four flags share it.
            steps = steps.withColumn("change", speed_change(ct1, sp1, ct2, sp2))
            measures |= harsh_events(sp1, sp2, F.col("change"), self.stop_speed, self.harsh)
        return steps.withColumns({f"{prefix}{name}": value for name, value in measures.items()})


def with_steps(samples: DataFrame, group: list[str], motion: Motion) -> DataFrame:
    """The measures of the step that leads to each sample.

    Distance is taken from the last known position, so samples without one are bridged. Events
    compare with the sample just before. The window functions take bare columns, so nothing but
    the samples themselves is shuffled.
    """
    in_order = ordered_samples(group, motion.order)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    ends = {}
    if motion.distance:
        ends |= {
            "lat1": F.last("latitude", ignorenulls=True).over(earlier),
            "lon1": F.last("longitude", ignorenulls=True).over(earlier),
            "lat2": F.col("latitude"),
            "lon2": F.col("longitude"),
        }
    if motion.events:
        ends |= {
            "ct1": F.lag("ct").over(in_order),
            "sp1": F.lag("sp").over(in_order),
            "ct2": F.col("ct"),
            "sp2": F.col("sp"),
        }
    return motion.measure(samples.withColumns(ends))


def sums(measures: list[str]) -> list[Column]:
    return [F.sum(measure).alias(measure) for measure in measures]


def seen_ends(motion: Motion) -> list[Column]:
    """First and last sample of a stretch, of all samples and of those with a position."""
    sample = F.struct(*motion.order)
    located = F.when(F.col("latitude").isNotNull(), sample)
    return [
        F.min(sample).alias("first"),
        F.max(sample).alias("last"),
        F.min(located).alias("first_located"),
        F.max(located).alias("last_located"),
    ]


def tile_pieces(
    samples: DataFrame, keys: list[str], motion: Motion, hot: HotGroups
) -> DataFrame:
    """Hot trips in pieces that follow each other: sums within a `tile`, and its ends.

    Copies of a sample are dropped first: there is no distance and no `ct` progress between them.
    """
    distinct = samples.select(*keys, *motion.order).distinct()
    stepped = with_steps(
        with_tiles(distinct, keys, hot, motion.order), [*keys, "tile"], motion
    )
    # Grouped in the key order of the window, whose sort then serves this aggregation as well.
    return stepped.groupBy("tile", *reversed(keys)).agg(
        *sums(motion.measures), *seen_ends(motion)
    )


def with_seams(
    pieces: DataFrame, keys: list[str], motion: Motion, order: list[str]
) -> DataFrame:
    """Add as `seam_…` the measures of the step to each piece from the one before it."""
    earlier = (
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    neighbours = pieces.withColumns(
        {
            "before": F.last("last").over(earlier),
            "before_located": F.last("last_located", ignorenulls=True).over(earlier),
        }
    )
    ends = {}
    if motion.distance:
        ends |= {
            "lat1": F.col("before_located.latitude"),
            "lon1": F.col("before_located.longitude"),
            "lat2": F.col("first_located.latitude"),
            "lon2": F.col("first_located.longitude"),
        }
    if motion.events:
        ends |= {
            "ct1": F.col("before.ct"),
            "sp1": F.col("before.sp"),
            "ct2": F.col("first.ct"),
            "sp2": F.col("first.sp"),
        }
    return motion.measure(neighbours.withColumns(ends), prefix="seam_")


def joined_sums(measures: list[str]) -> list[Column]:
    """Sums over pieces and over the seams before them."""
    return [F.sum(F.col(name) + F.col(f"seam_{name}")).alias(name) for name in measures]


def _tiled_motion(
    samples: DataFrame, keys: list[str], motion: Motion, hot: HotGroups
) -> DataFrame:
    """Motion of hot trips: steps within tiles, plus the seams between one tile and the next."""
    pieces = tile_pieces(samples, keys, motion, hot)
    measured = with_seams(pieces, keys, motion, ["tile"])
    return measured.groupBy(*keys).agg(*joined_sums(motion.measures))


def _trip_motion(
    samples: DataFrame, keys: list[str], motion: Motion, max_group_rows: int | None
) -> DataFrame:
    def small(rows: DataFrame) -> DataFrame:
        return with_steps(rows, keys, motion).groupBy(*keys).agg(*sums(motion.measures))

    def large(rows: DataFrame, hot: HotGroups) -> DataFrame:
        return _tiled_motion(rows, keys, motion, hot)

    return by_group_size(motion.inputs(samples), keys, small, large, max_group_rows)


def trip_distance(
    samples: DataFrame, keys: list[str], max_group_rows: int | None = None
) -> DataFrame:
    """Path length of each trip in whole metres."""
    paths = _trip_motion(samples, keys, Motion(events=False), max_group_rows)
    return paths.select(*keys, whole(F.col(DISTANCE)).alias("total_distance"))


def driving_events(
    samples: DataFrame,
    keys: list[str],
    stop_speed: float = STOP_SPEED,
    harsh: float = HARSH_CHANGE,
    max_group_rows: int | None = None,
) -> DataFrame:
    """Sudden starts, sudden stops, accelerations and decelerations of each trip.

    Only `ct` and `sp` decide; positions merely break ties in the order.
    """
    motion = Motion(distance=False, stop_speed=stop_speed, harsh=harsh)
    return _trip_motion(samples, keys, motion, max_group_rows)


def attach_events(trips: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """Event counts joined to their trips; trips with a NULL key have no match and drop out."""
    return trips.join(events, on=keys, how="inner")


def motion_of(grain: Grain, formulas: Motion | None) -> Motion:
    """What the statistic of a grain measures, by our formulas or by given ones."""
    return replace(formulas or Motion(), distance=True, events=grain.has_events)


def trip_rows(
    samples: DataFrame,
    grain: Grain,
    max_group_rows: int | None = None,
    formulas: Motion | None = None,
) -> DataFrame:
    """All measures of each trip from one pass over the ordered samples.

    At the grains with events, trips with a NULL key are left out, as the join on the keys in
    `attach_events` would.
    """
    keys, motion = grain.trip_keys, motion_of(grain, formulas)

    def small(rows: DataFrame) -> DataFrame:
        # One row per trip, user and vehicle, then one per trip: both reuse the partitioning of
        # the window, and the sets hold no more than a group's row limit.
        pairs = (
            with_steps(rows, keys, motion)
            .groupBy(*keys, "user_id", "vehicle_id")
            .agg(
                F.count("ct").alias("total_driving_time"),
                *sums(motion.measures),
            )
        )
        return pairs.groupBy(*keys).agg(
            F.size(F.collect_set("user_id")).cast("long").alias("user_count"),
            F.size(F.collect_set("vehicle_id")).cast("long").alias("vehicle_count"),
            F.sum("total_driving_time").alias("total_driving_time"),
            *sums(motion.measures),
        )

    def large(rows: DataFrame, hot: HotGroups) -> DataFrame:
        # Each hot trip has one row of counts and one of motion; `max` puts the two together.
        counts = trip_agg(rows, keys).drop("size_of_latitude")
        moved = _tiled_motion(rows, keys, motion, hot)
        halves = counts.unionByName(moved, allowMissingColumns=True)
        values = [column for column in halves.columns if column not in keys]
        return halves.groupBy(*keys).agg(*[F.max(value).alias(value) for value in values])

    trips = by_group_size(
        motion.inputs(samples), keys, small, large, max_group_rows, grain.has_events
    )
    return trips.withColumn("total_distance", whole(F.col(DISTANCE))).drop(DISTANCE)
