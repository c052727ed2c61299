"""Ordered sample lists of each trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripgrain.durable import cut_lineage
from tripgrain.operators.skew import (
    HotGroups,
    by_group_size,
    join_keys,
    ordered_samples,
    with_tiles,
)
from tripgrain.schema import SAMPLE_ORDER

PIECE_ROWS = 10_000


def _gather(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Lists from rows of `piece`, `start` and `copies`, in order of `start`."""
    run = F.struct("start", "copies", F.struct(*SAMPLE_ORDER).alias("sample"))
    runs = F.array_sort(F.collect_list(run))
    samples = F.flatten(
        F.transform(runs, lambda run: F.array_repeat(run["sample"], run["copies"].cast("int")))
    )
    return placed.groupBy(*keys, "piece").agg(samples.alias("trace"))


def _whole_trips(samples: DataFrame, keys: list[str], piece_rows: int) -> DataFrame:
    in_order = ordered_samples(keys)
    ranked = samples.withColumn("start", F.row_number().over(in_order).cast("long") - 1)
    placed = ranked.withColumns(
        {"piece": F.floor(F.col("start") / piece_rows), "copies": F.lit(1)}
    )
    return _gather(placed, keys)


def _tiled_trips(
    samples: DataFrame, keys: list[str], piece_rows: int, hot: HotGroups
) -> DataFrame:
    """Lists of hot trips: ranks within tiles, moved up by the rows of the tiles before.

    Copies of a sample travel as one row with a count until their place is known. The tiled rows
    are stored, because ranks and tile totals must agree on where the tiles begin.
    """
    runs = samples.groupBy(*keys, *SAMPLE_ORDER).agg(F.count(F.lit(1)).alias("copies"))
    tiled = cut_lineage(with_tiles(runs, keys, hot))

    by_tile = Window.partitionBy(*keys).orderBy("tile")
    earlier_tiles = by_tile.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tiled.groupBy(*keys, "tile")
        .agg(F.sum("copies").alias("rows"))
        .withColumn("offset", F.coalesce(F.sum("rows").over(earlier_tiles), F.lit(0)))
        .drop("rows")
    )
    # A tile is a stretch, so each boundary adds one row to those of the groups; a partition's first
    # and last tile may be short.
    pieces_at_most = hot.count + hot.tiles + 2 * hot.ranges
    tiled = join_keys(tiled, offsets, [*keys, "tile"], "inner", pieces_at_most)

    in_order = ordered_samples([*keys, "tile"])
    earlier_rows = in_order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("copies").over(earlier_rows), F.lit(0))
    spans = tiled.withColumn("start", start).withColumn("end", F.col("start") + F.col("copies"))

    pieces = F.sequence(
        F.floor(F.col("start") / piece_rows), F.floor((F.col("end") - 1) / piece_rows)
    )
    placed = spans.withColumn("piece", F.explode(pieces))
    piece_start = F.col("piece") * piece_rows
    placed = placed.withColumns(
        {
            "copies": F.least(F.col("end"), piece_start + piece_rows)
            - F.greatest(F.col("start"), piece_start)
        }
    )
    return _gather(placed, keys)


def ordered_trace(
    samples: DataFrame,
    keys: list[str],
    piece_rows: int = PIECE_ROWS,
    max_group_rows: int | None = None,
) -> DataFrame:
    """Each trip's samples as arrays of structs in sample order.

    A trip is cut into numbered pieces of `piece_rows` samples, so that no row grows without
    bound; pieces 0, 1, 2… put end to end are the whole trip, and most trips have only piece 0.
    """
    return by_group_size(
        samples.select(*keys, *[c for c in SAMPLE_ORDER if c not in keys]),
        keys,
        lambda rows: _whole_trips(rows, keys, piece_rows),
        lambda rows, hot: _tiled_trips(rows, keys, piece_rows, hot),
        max_group_rows,
    )
