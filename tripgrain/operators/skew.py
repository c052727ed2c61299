"""Splitting of groups too large for one task.

Steps between neighbouring samples need a trip's samples together and in order, so a trip is
normally one window partition. A real trip sampled once a second has at most 86,400 samples a day;
a group far above that (a missing or default trip id) may hold a large share of the table. Such hot
groups are found by an exact count and cut into ordered tiles, which the callers work on
separately and stitch together. Results are the same either way.

Every group above the limit is hot, however many there are, and the number of tiles follows their
rows. Their keys are broadcast while they are few enough, by count, and joined by shuffle beyond.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tripgrain.durable import cut_lineage
from tripgrain.schema import SAMPLE_ORDER

MAX_GROUP_ROWS = 1_000_000
# Rows of keys that may be broadcast; more of them are joined by shuffle.
MAX_BROADCAST_ROWS = 200_000


def ordered_samples(group: list[str], order: list[str] = SAMPLE_ORDER) -> WindowSpec:
    """The samples of each group in order.

    The last key, which tells most groups apart, comes first: Spark's sort compares a prefix of
    the first column before whole rows.
    """
    return Window.partitionBy(*reversed(group)).orderBy(*order)


@dataclass(frozen=True)
class HotGroups:
    """The keys of the hot groups, and the number of tiles to cut them into."""

    groups: DataFrame
    count: int
    tiles: int
    tile_rows: int = MAX_GROUP_ROWS

    @property
    def ranges(self) -> int:
        """Spark partitions to sort hot rows in.

        No more than the session shuffles with, unless one would hold over `MAX_GROUP_ROWS` rows: the
        driver takes a sample of each to place their bounds, so they must not follow a small limit.
        """
        usual = int(self.groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return min(self.tiles, max(usual, -(-self.tiles * self.tile_rows // MAX_GROUP_ROWS)))

    def select_from(self, samples: DataFrame, keys: list[str], how: str) -> DataFrame:
        return join_keys(samples, self.groups.select(*keys), keys, how, self.count)


def join_keys(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, rows: int
) -> DataFrame:
    """Equi-join where NULL keys match, keeping the left names.

    `rows` is what `right` has at most; up to `MAX_BROADCAST_ROWS` it is broadcast.
    """
    right = right.withColumnsRenamed({key: f"_{key}" for key in keys})
    if rows <= MAX_BROADCAST_ROWS:
        right = F.broadcast(right)
    matches = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
    return left.join(right, matches, how).drop(*[f"_{key}" for key in keys])


def without_null_keys(samples: DataFrame, keys: list[str]) -> DataFrame:
    return samples.filter(reduce(and_, [F.col(key).isNotNull() for key in keys]))


def find_hot_groups(
    samples: DataFrame, keys: list[str], max_group_rows: int, drop_null_keys: bool = False
) -> HotGroups | None:
    """Groups of more than `max_group_rows` samples, counted exactly; None if there are none.

    A table within the limit as a whole is settled by its row count, which Parquet answers from
    file footers. Otherwise the key columns are scanned and counted with map-side combining.
    """
    if samples.count() <= max_group_rows:
        return None
    if drop_null_keys:
        samples = without_null_keys(samples, keys)
    sizes = samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    groups = cut_lineage(sizes.filter(F.col("rows") > max_group_rows))
    found = groups.agg(F.count(F.lit(1)).alias("groups"), F.sum("rows").alias("rows")).first()
    if not found["groups"]:
        return None
    tiles = -(-found["rows"] // max_group_rows)
    return HotGroups(groups, found["groups"], tiles, max_group_rows)


def by_group_size(
    samples: DataFrame,
    keys: list[str],
    small: Callable[[DataFrame], DataFrame],
    large: Callable[[DataFrame, HotGroups], DataFrame],
    max_group_rows: int | None = None,
    drop_null_keys: bool = False,
) -> DataFrame:
    """`small` over the ordinary groups together with `large` over the hot ones."""
    limit = max_group_rows or MAX_GROUP_ROWS
    hot = find_hot_groups(samples, keys, limit, drop_null_keys)
    if drop_null_keys:
        samples = without_null_keys(samples, keys)
    if hot is None:
        return small(samples)
    ordinary = hot.select_from(samples, keys, "left_anti")
    # Stored, because `large` reads them more than once.
    oversized = cut_lineage(hot.select_from(samples, keys, "left_semi"))
    return small(ordinary).unionByName(large(oversized, hot))


def with_tiles(
    samples: DataFrame, keys: list[str], hot: HotGroups, order: list[str] = SAMPLE_ORDER
) -> DataFrame:
    """Cut groups into `tile`s: stretches of `tile_rows` rows that follow each other in sample order.

    Rows are sorted in `ranges` partitions, each of which is cut by row numbers, so that neither the
    tasks nor the driver's sample of bounds grow with the number of tiles. Rows equal in all of `order`
    cannot be told apart by a range, so callers merge copies first.
    """
    ranged = samples.repartitionByRange(hot.ranges, *keys, *order)
    # Row numbers start anew in each partition, far above those of the one before.
    number = F.expr(f"monotonically_increasing_id() div {hot.tile_rows}")
    return ranged.sortWithinPartitions(*keys, *order).withColumn("tile", number)
