"""Maintain a gold table from a growing table of position samples."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tripgrain.durable import cut_lineage
from tripgrain.operators.trips import Motion
from tripgrain.plans.provenance import (
    by_gold_partition,
    gold_names,
    has_provenance,
    note_provenance,
    partition_pairs,
    same_partition,
    source_partitions,
    sources_of,
)
from tripgrain.plans.statistics import driving_stat
from tripgrain.schema import Grain
from tripgrain.sinks.gold import (
    FULL_LOAD,
    INCREMENTAL,
    check_owner,
    register_partitions,
    repair_registration,
    replace_partitions,
    target_exists,
    write_gold,
)
from tripgrain.sources.positions import (
    consumed_until,
    incremental,
    latest_partition,
    note_consumed,
    partitions_from,
    watermark_of,
)


def resolve_load_type(spark: SparkSession, load_type: str, table: str, path: str) -> str:
    """Check the load type; an incremental load without history becomes a full one."""
    if load_type not in (FULL_LOAD, INCREMENTAL):
        raise ValueError(f"load type must be {FULL_LOAD} or {INCREMENTAL}, not {load_type!r}")
    if load_type == INCREMENTAL and not target_exists(spark, table, path):
        return FULL_LOAD
    return load_type


def samples_to_compute(
    batch: DataFrame, positions: DataFrame, pairs: DataFrame, grain: Grain, target_path: str
) -> DataFrame:
    """The batch, with all earlier samples of the buckets that are written already.

    Source and event time may differ, so a batch can reach into buckets that earlier batches
    filled. Those are computed again from everything known of them, never from the batch alone:
    from the source partitions that are noted to have fed them, or where that was never noted,
    from the whole source. Where there are none, nothing but the batch is read. `pairs` are the
    source and gold partitions of the batch.
    """
    spark, names = batch.sparkSession, gold_names(grain)
    kinds = ", ".join(f"{name} int" for name in grain.partitions)
    written = spark.read.schema(kinds).parquet(target_path).toDF(*names).distinct()
    # Both sides have one row per gold partition.
    touched = pairs.select(*names).distinct()
    again = cut_lineage(touched.join(written, same_partition(touched, written, names), "left_semi"))
    if again.isEmpty():
        return batch
    sources = sources_of(again, pairs, target_path, grain)
    known = positions if sources is None else positions.filter(sources)
    everything, new = by_gold_partition(known, grain), by_gold_partition(batch, grain)
    whole = everything.join(again, same_partition(everything, again, names), "left_semi")
    rest = new.join(again, same_partition(new, again, names), "left_anti")
    return whole.unionByName(rest).select(*positions.columns)


def refresh(
    positions: DataFrame,
    grain: Grain,
    target_path: str,
    table: str,
    load_type: str = INCREMENTAL,
    max_group_rows: int | None = None,
    formulas: Motion | None = None,
    repair_from: datetime | None = None,
) -> str | None:
    """Bring the gold table of a grain up to date; returns the load type that ran, if any did.

    An incremental load takes the source partitions strictly later than the last one that a
    complete load consumed, so samples that arrive late for a consumed partition stay out unless
    `repair_from` names the partition to start again from. With nothing new, nothing is written.

    A batch replaces exactly the gold partitions it touches, computed from all their samples, and
    what was consumed is noted last. A run that was lost anywhere is made good by the next one,
    and running twice changes nothing.
    """
    spark = positions.sparkSession
    load_type = resolve_load_type(spark, load_type, table, target_path)
    check_owner(spark, table, target_path)
    batch = positions
    if load_type == INCREMENTAL:
        consumed = consumed_until(spark, target_path, grain)
        written = watermark_of(spark, target_path, grain)
        watermark = consumed or written
        if watermark is None:
            load_type = FULL_LOAD
        else:
            if written is not None:
                repair_registration(spark, table, grain, written)
            batch = incremental(positions, grain, watermark)
            if repair_from is not None:
                batch = positions.filter(partitions_from(grain, min(repair_from, watermark)))
    # One pass over the partition columns and times tells all that is asked of the batch.
    pairs = cut_lineage(partition_pairs(batch, grain))
    if pairs.isEmpty():
        return None
    latest = latest_partition(source_partitions(pairs, grain), grain).first()["latest_ts"]
    samples = batch
    if load_type == INCREMENTAL:
        samples = samples_to_compute(batch, positions, pairs, grain, target_path)
    # One row per bucket: computed once, then written and listed from storage.
    gold = cut_lineage(driving_stat(samples, grain, max_group_rows, formulas))
    if load_type == FULL_LOAD:
        write_gold(gold, grain, target_path, load_type)
    else:
        replace_partitions(gold, grain, target_path)
    register_partitions(spark, table, target_path, grain, gold, load_type)
    # A map that lacks an earlier batch would lose samples, so only a full load begins one.
    if load_type == FULL_LOAD or has_provenance(spark, target_path):
        note_provenance(pairs, target_path)
    note_consumed(spark, target_path, grain, latest)
    return load_type
