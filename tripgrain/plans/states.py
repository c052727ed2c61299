"""Statistics from stored trip states: late and early batches are merged, not read again."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.durable import cut_lineage
from tripgrain.operators.rollup import bucket_rollup
from tripgrain.operators.trip_state import exact_trips, merged_state, state_trips, trip_state
from tripgrain.operators.trips import Motion
from tripgrain.plans.provenance import (
    has_provenance,
    note_provenance,
    partition_pairs,
    read_provenance,
    sources_of,
)
from tripgrain.plans.statistics import finish_buckets, position_samples
from tripgrain.schema import Grain


def _batch_path(path: str, batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
        raise ValueError(f"a batch is named by letters, digits, _ and -, not {batch!r}")
    return f"{path}/batch={batch}"


def add_batch(
    positions: DataFrame,
    grain: Grain,
    path: str,
    batch: str,
    max_group_rows: int | None = None,
    formulas: Motion | None = None,
) -> None:
    """Store the state of a batch of samples, which may lie anywhere in time.

    A batch that is added again under its name takes its own place, so a lost run is made good by
    repeating it. The source partitions that fed each bucket are noted first, where there are any.
    """
    target = _batch_path(path, batch)
    if set(grain.partitions) <= set(positions.columns):
        note_provenance(partition_pairs(positions, grain), path)
    samples = position_samples(positions, grain)
    trip_state(samples, grain, batch, max_group_rows, formulas).write.mode("overwrite").parquet(
        target
    )


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")


def compact_states(
    spark: SparkSession, path: str, target: str, grain: Grain, formulas: Motion | None = None
) -> None:
    """Write one merged batch to another path, with the map of source partitions."""
    state = merged_state(read_states(spark, path), grain, "merged", formulas)
    state.write.mode("overwrite").parquet(_batch_path(target, "merged"))
    if has_provenance(spark, path):
        note_provenance(read_provenance(spark, path, grain).distinct(), target)


def stat_from_states(
    positions: DataFrame,
    grain: Grain,
    path: str,
    max_group_rows: int | None = None,
    formulas: Motion | None = None,
) -> DataFrame:
    """The gold table of all batches stored, equal to `driving_stat` over all their samples.

    `positions` is read only if batches overlap within a trip: then those trips are computed again
    from it, from the source partitions that fed their buckets if these were noted.
    """
    trips = cut_lineage(state_trips(read_states(positions.sparkSession, path), grain, formulas))
    torn = trips.filter("interleaved")
    if torn.isEmpty():
        exact = trips.drop("interleaved")
    else:
        sources = _sources(torn, grain, path)
        known = positions if sources is None else positions.filter(sources)
        samples = position_samples(known, grain)
        exact = exact_trips(trips, samples, grain, max_group_rows, formulas)
    return finish_buckets(bucket_rollup(exact, grain), grain)


def _sources(torn: DataFrame, grain: Grain, path: str):
    """Condition on the source partitions of the buckets of trips; None if they are not known."""
    spark = torn.sparkSession
    if not has_provenance(spark, path):
        return None
    parts = {
        "year": F.year("date"), "month": F.month("date"), "day": F.dayofmonth("date"),
    } | ({"hour": F.col("hour")} if grain.name == "hour" else {})
    buckets = torn.select(*[parts[name].alias(f"gold_{name}") for name in grain.partitions])
    return sources_of(buckets.distinct(), read_provenance(spark, path, grain).limit(0), path, grain)
