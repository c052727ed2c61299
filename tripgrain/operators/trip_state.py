"""State of trips that batches of samples leave behind, and that merges without the samples.

A state has one row per trip, piece, user and vehicle. A piece is a stretch of a trip in sample
order: the sums of its steps, its first and last sample, and the first and last one with a position.
Pieces that lie one behind the other are joined by the steps over their seams, in whatever order
their batches came. Pieces that overlap have lost the order between them: their trip is
`interleaved`, and only its samples have to be read again.

A state is only to be merged with states of the same grain and formulas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripgrain.functions.measures import whole
from tripgrain.operators.skew import HotGroups, by_group_size
from tripgrain.operators.trips import (
    DISTANCE,
    Motion,
    joined_sums,
    motion_of,
    seen_ends,
    sums,
    tile_pieces,
    trip_rows,
    with_seams,
    with_steps,
)
from tripgrain.schema import Grain

SECONDS = "total_driving_time"
ENDS = ["first", "last", "first_located", "last_located"]


def trip_state(
    samples: DataFrame,
    grain: Grain,
    batch: str,
    max_group_rows: int | None = None,
    formulas: Motion | None = None,
) -> DataFrame:
    """The state of one batch, whose name begins the names of its pieces.

    An ordinary trip is one piece; its rows per user and vehicle hold parts of the sums, and ends
    that together are those of the piece. A hot trip has a piece per tile, in rows without a user.
    """
    keys, motion = grain.trip_keys, motion_of(grain, formulas)
    seconds = F.count("ct").alias(SECONDS)

    def small(rows: DataFrame) -> DataFrame:
        return (
            with_steps(rows, keys, motion)
            .groupBy(*keys, "user_id", "vehicle_id")
            .agg(seconds, *sums(motion.measures), *seen_ends(motion))
            .withColumn("piece", F.lit(batch))
        )

    def large(rows: DataFrame, hot: HotGroups) -> DataFrame:
        pieces = tile_pieces(rows, keys, motion, hot)
        named = pieces.withColumn("piece", F.concat_ws("/", F.lit(batch), "tile")).drop("tile")
        counts = rows.groupBy(*keys, "user_id", "vehicle_id").agg(seconds)
        return counts.unionByName(named, allowMissingColumns=True).select(
            *keys, "user_id", "vehicle_id", SECONDS, *motion.measures, *ENDS, "piece"
        )

    return by_group_size(
        motion.inputs(samples), keys, small, large, max_group_rows, grain.has_events
    )


def _pieces(state: DataFrame, keys: list[str], motion: Motion) -> DataFrame:
    """Pieces with the measures of the seams before them; `late` where one before reaches over."""
    pieces = (
        state.filter(F.col("first").isNotNull())
        .groupBy(*keys, "piece")
        .agg(*sums(motion.measures), *_joined_ends())
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("first", "last")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    late = F.coalesce(F.max("last").over(earlier) > F.col("first"), F.lit(False))
    return with_seams(pieces.withColumn("late", late), keys, motion, ["first", "last"])


def _joined_ends() -> list:
    least = [F.min(name).alias(name) for name in ("first", "first_located")]
    return least + [F.max(name).alias(name) for name in ("last", "last_located")]


def merged_state(
    state: DataFrame, grain: Grain, batch: str, formulas: Motion | None = None
) -> DataFrame:
    """An equal state of fewer rows: one piece per trip; those of interleaved trips stay apart."""
    keys, motion = grain.trip_keys, motion_of(grain, formulas)
    counts = state.groupBy(*keys, "user_id", "vehicle_id").agg(F.sum(SECONDS).alias(SECONDS))
    pieces = _pieces(state, keys, motion).withColumn(
        "interleaved", F.max("late").over(Window.partitionBy(*keys))
    )
    # A piece that is kept has no seam, as its neighbours are to be found anew.
    seams = {
        f"seam_{name}": F.when(F.col("interleaved"), 0).otherwise(F.col(f"seam_{name}"))
        for name in motion.measures
    }
    name = F.when(F.col("interleaved"), F.col("piece")).otherwise(batch)
    joined = (
        pieces.withColumns({**seams, "piece": name})
        .groupBy(*keys, "piece")
        .agg(*joined_sums(motion.measures), *_joined_ends())
    )
    return counts.unionByName(joined, allowMissingColumns=True).select(*state.columns)


def state_trips(state: DataFrame, grain: Grain, formulas: Motion | None = None) -> DataFrame:
    """The rows of `trip_rows`, and whether the trip is `interleaved`, which voids its motion."""
    keys, motion = grain.trip_keys, motion_of(grain, formulas)
    # One row per user and vehicle first, so that no set of them has to fit in one task.
    counts = (
        state.groupBy(*keys, "user_id", "vehicle_id")
        .agg(F.sum(SECONDS).alias(SECONDS))
        .groupBy(*keys)
        .agg(
            F.count_distinct("user_id").alias("user_count"),
            F.count_distinct("vehicle_id").alias("vehicle_count"),
            F.sum(SECONDS).alias(SECONDS),
        )
    )
    moved = (
        _pieces(state, keys, motion)
        .groupBy(*keys)
        .agg(*joined_sums(motion.measures), F.max("late").alias("interleaved"))
    )
    # Each trip has one row of counts and one of motion; `max` puts the two together.
    halves = counts.unionByName(moved, allowMissingColumns=True)
    values = [column for column in halves.columns if column not in keys]
    trips = halves.groupBy(*keys).agg(*[F.max(value).alias(value) for value in values])
    return trips.withColumn("total_distance", whole(F.col(DISTANCE))).drop(DISTANCE)


def exact_trips(
    trips: DataFrame,
    samples: DataFrame,
    grain: Grain,
    max_group_rows: int | None = None,
    formulas: Motion | None = None,
) -> DataFrame:
    """Stored trips of a state with the interleaved ones computed again from their samples."""
    torn = trips.filter("interleaved").select(*grain.trip_keys)
    chosen = HotGroups(torn, torn.count(), 1).select_from(samples, grain.trip_keys, "left_semi")
    again = trip_rows(chosen, grain, max_group_rows, formulas)
    return trips.filter("not interleaved").drop("interleaved").unionByName(again)
