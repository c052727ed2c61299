"""Queries over the sample tables and the SQL that gives the same answers."""

from __future__ import annotations

import importlib.util
import sys
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tripgrain.durable import scratch_path  # noqa: E402
from tripgrain.functions.measures import driving_minutes, trip_averages  # noqa: E402
from tripgrain.functions.timestamps import (  # noqa: E402
    TS_FORMAT,
    partition_timestamp,
    with_time_columns,
    year_month,
)
from tripgrain.operators.rollup import bucket_rollup  # noqa: E402
from tripgrain.operators.traces import ordered_trace  # noqa: E402
from tripgrain.operators.trips import (  # noqa: E402
    Motion,
    attach_events,
    driving_events,
    trip_agg,
    trip_distance,
    trip_rows,
)
from tripgrain.plans.refresh import refresh  # noqa: E402
from tripgrain.plans.states import add_batch, compact_states, stat_from_states  # noqa: E402
from tripgrain.plans.statistics import driving_stat, monthly_stat, position_samples  # noqa: E402
from tripgrain.schema import (  # noqa: E402
    DAY,
    EVENT_COUNTS,
    GRAINS,
    HOUR,
    MONTH,
    POSITION_COLUMNS,
    Grain,
)
from tripgrain.sinks.gold import (  # noqa: E402
    FULL_LOAD,
    INCREMENTAL,
    partition_paths,
    register_partitions,
    write_gold,
    write_partitioned,
)
from tripgrain.sinks.versions import APPEND, OVERWRITE, REPLACE, publish, read_published, stage  # noqa: E402
from tripgrain.sources.listing import latest_partition_listed  # noqa: E402
from tripgrain.sources.positions import (  # noqa: E402
    incremental,
    latest_partition,
    latest_partition_sql,
    partitions_after,
    read_positions,
)
from tripgrain.sources.sample_tables import event_positions, order_positions  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

WATERMARKS = {
    "hour": datetime(2024, 1, 15, 12),
    "day": datetime(2024, 1, 15),
    "month": datetime(1998, 6, 1),
}


def _positions(spark: SparkSession, sf_dir: str, grain: Grain) -> DataFrame:
    return (order_positions if grain is MONTH else event_positions)(spark, sf_dir)


def _samples(spark: SparkSession, sf_dir: str, grain: Grain) -> DataFrame:
    return position_samples(_positions(spark, sf_dir, grain), grain)


# Groups above this many rows are split in the `_hot_groups` queries.
HOT_ROWS = 80


# --- queries -----------------------------------------------------------------------------------


def scan_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_positions(spark, sf_dir)


def position_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_positions(spark, sf_dir).select(*POSITION_COLUMNS)


def time_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_text = event_positions(spark, sf_dir).select(
        "ct", F.date_format("ts", TS_FORMAT).alias("ts")
    )
    return with_time_columns(as_text).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def year_month_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    positions = order_positions(spark, sf_dir)
    return positions.select("ct", year_month(F.year("ts"), F.month("ts")).alias("year_month"))


def driving_minutes_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = bucket_rollup(trip_rows(_samples(spark, sf_dir, DAY), DAY), DAY)
    return buckets.select(
        "date", "day", driving_minutes(F.col("total_driving_time")).alias("total_driving_time")
    )


def partition_timestamps(grain: Grain) -> Query:
    def query(spark, sf_dir):
        parts = _positions(spark, sf_dir, grain).select(*grain.partitions).distinct()
        return parts.withColumn("partition_ts", partition_timestamp(grain))

    return query


def scan_incremental(grain: Grain) -> Query:
    return lambda spark, sf_dir: incremental(
        _positions(spark, sf_dir, grain), grain, WATERMARKS[grain.name]
    )


def latest(grain: Grain) -> Query:
    return lambda spark, sf_dir: latest_partition(_positions(spark, sf_dir, grain), grain)


def latest_by_sql(grain: Grain) -> Query:
    return lambda spark, sf_dir: latest_partition_sql(_positions(spark, sf_dir, grain), grain)


def latest_by_listing(grain: Grain) -> Query:
    """The latest partition of a table on disk, told from its directories."""

    def query(spark, sf_dir):
        path = scratch_path(spark, f"silver-{grain.name}")
        write_partitioned(_positions(spark, sf_dir, grain), grain.partitions, path, "overwrite")
        return latest_partition_listed(spark, path, grain)

    return query


def trips(grain: Grain) -> Query:
    return lambda spark, sf_dir: trip_agg(_samples(spark, sf_dir, grain), grain.trip_keys)


def _render(traces: DataFrame, keys: list[str]) -> DataFrame:
    def shown(sample):
        return F.concat(sample["ct"].cast("string"), F.lit(":"), sample["latitude"].cast("string"))

    text = F.transform("trace", shown)
    return traces.select(
        *keys,
        F.col("piece").cast("long").alias("piece"),
        F.size("trace").alias("samples"),
        F.array_join(text, ",").alias("trace"),
    )


def traces(grain: Grain) -> Query:
    return lambda spark, sf_dir: _render(
        ordered_trace(_samples(spark, sf_dir, grain), grain.trip_keys), grain.trip_keys
    )


def traces_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = _samples(spark, sf_dir, DAY)
    pieces = ordered_trace(
        samples, DAY.trip_keys, piece_rows=50, max_group_rows=HOT_ROWS
    )
    return _render(pieces, DAY.trip_keys)


def distances(grain: Grain) -> Query:
    return lambda spark, sf_dir: trip_distance(_samples(spark, sf_dir, grain), grain.trip_keys)


def distances_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = _samples(spark, sf_dir, DAY)
    return trip_distance(samples, DAY.trip_keys, max_group_rows=HOT_ROWS)


def events(grain: Grain) -> Query:
    return lambda spark, sf_dir: driving_events(_samples(spark, sf_dir, grain), grain.trip_keys)


def events_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = _samples(spark, sf_dir, DAY)
    return driving_events(samples, DAY.trip_keys, max_group_rows=HOT_ROWS)


def trips_with_events(grain: Grain) -> Query:
    def query(spark, sf_dir):
        samples, keys = _samples(spark, sf_dir, grain), grain.trip_keys
        return attach_events(trip_agg(samples, keys), driving_events(samples, keys), keys)

    return query


def rollups(grain: Grain) -> Query:
    return lambda spark, sf_dir: bucket_rollup(
        trip_rows(_samples(spark, sf_dir, grain), grain), grain
    )


def averages(grain: Grain) -> Query:
    return lambda spark, sf_dir: (
        rollups(grain)(spark, sf_dir)
        .withColumns({"total_driving_time": driving_minutes(F.col("total_driving_time"))})
        .withColumns(trip_averages(grain))
        .select(*grain.bucket_keys, *grain.averaged)
    )


def stats(grain: Grain) -> Query:
    return lambda spark, sf_dir: driving_stat(_positions(spark, sf_dir, grain), grain)


def daily_stat_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driving_stat(event_positions(spark, sf_dir), DAY, max_group_rows=HOT_ROWS)


def hourly_stat_text_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as text, the form of the raw samples."""
    positions = event_positions(spark, sf_dir)
    return driving_stat(positions.withColumn("ts", F.date_format("ts", TS_FORMAT)), HOUR)


def straight_metres(lat1, lon1, lat2, lon2):
    """Taxicab distance on a plane, as a formula other than ours."""
    metres = (F.abs(lat2 - lat1) + F.abs(lon2 - lon1)) * 100_000.0
    return F.coalesce(metres, F.lit(0.0))


def daily_stat_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other limits for events and another distance between points."""
    formulas = Motion(stop_speed=40.0, harsh=3.5, step_distance=straight_metres)
    return driving_stat(event_positions(spark, sf_dir), DAY, formulas=formulas)


def monthly_stat_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_stat(order_positions(spark, sf_dir), collapse=True)


def paths(grain: Grain) -> Query:
    return lambda spark, sf_dir: partition_paths(stats(grain)(spark, sf_dir), grain)


def _until(positions: DataFrame, grain: Grain) -> DataFrame:
    return positions.filter(~partitions_after(grain, WATERMARKS[grain.name]))


def _written(spark: SparkSession, path: str, grain: Grain) -> DataFrame:
    return spark.read.parquet(path).select(*grain.gold_columns)


def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold-day")
    positions = event_positions(spark, sf_dir)
    for batch in (_until(positions, DAY), positions):
        write_gold(driving_stat(batch, DAY), DAY, path, FULL_LOAD)
    return _written(spark, path, DAY)


def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold-day")
    positions = event_positions(spark, sf_dir)
    write_gold(driving_stat(_until(positions, DAY), DAY), DAY, path, FULL_LOAD)
    later = incremental(positions, DAY, WATERMARKS["day"])
    write_gold(driving_stat(later, DAY), DAY, path, INCREMENTAL)
    return _written(spark, path, DAY)


def write_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three published versions of a table, and one writer that never came to publish."""
    path = scratch_path(spark, "published-day")
    positions = event_positions(spark, sf_dir)
    early = driving_stat(_until(positions, DAY), DAY)
    later = driving_stat(incremental(positions, DAY, WATERMARKS["day"]), DAY)
    publish(early, DAY.partitions, path, OVERWRITE)
    stage(later, DAY.partitions, path)
    publish(later, DAY.partitions, path, APPEND)
    publish(driving_stat(positions, DAY).filter("day > 10"), DAY.partitions, path, REPLACE)
    return read_published(spark, path, DAY.partitions).select(*DAY.gold_columns)


def catalog_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold_day")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    positions = event_positions(spark, sf_dir)
    for batch, load_type in (
        (_until(positions, DAY), FULL_LOAD),
        (incremental(positions, DAY, WATERMARKS["day"]), INCREMENTAL),
    ):
        gold = driving_stat(batch, DAY)
        write_gold(gold, DAY, path, load_type)
        register_partitions(spark, table, path, DAY, gold, load_type)
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    spark.sql(f"DROP TABLE {table}")
    return listed


def refreshed(grain: Grain) -> Query:
    """A full load up to the watermark, then the rest incrementally, then a run with no news."""

    def query(spark, sf_dir):
        target = scratch_path(spark, f"gold-{grain.name}")
        table = target.rsplit("/", 1)[1].replace("-", "_")
        positions = _positions(spark, sf_dir, grain)
        for arrived in (_until(positions, grain), positions, positions):
            refresh(arrived, grain, target, table)
        spark.sql(f"DROP TABLE {table}")
        return _written(spark, target, grain)

    return query


def _source_shifted(positions: DataFrame) -> DataFrame:
    """One sample in five stored a day after it was taken."""
    arrived = F.when(F.col("ct") % 5 == 0, F.date_add("ts", 1)).otherwise(F.to_date("ts"))
    return positions.withColumns(
        {"year": F.year(arrived), "month": F.month(arrived), "day": F.dayofmonth(arrived)}
    )


def _in_gold(spark: SparkSession, runs: Callable[[str, str], None]) -> str:
    """Run refreshes on a fresh table and drop its entry; returns where it lies."""
    target = scratch_path(spark, "gold-day")
    table = target.rsplit("/", 1)[1].replace("-", "_")
    runs(target, table)
    spark.sql(f"DROP TABLE {table}")
    return target


def refresh_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples that arrive in a later source partition, refreshed three times."""
    positions = _source_shifted(event_positions(spark, sf_dir))

    def runs(target, table):
        for arrived in (_until(positions, DAY), positions, positions):
            refresh(arrived, DAY, target, table)

    return _written(spark, _in_gold(spark, runs), DAY)


def refresh_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late samples of consumed partitions, taken in by starting again from the tenth."""
    positions = event_positions(spark, sf_dir)
    in_time = positions.filter(~((F.dayofmonth("ts") >= 10) & (F.col("ct") % 7 == 0)))

    def runs(target, table):
        refresh(in_time, DAY, target, table)
        refresh(positions, DAY, target, table, repair_from=datetime(2024, 1, 10))

    return _written(spark, _in_gold(spark, runs), DAY)


def from_states(grain: Grain) -> Query:
    """The statistic merged from four batches, two of them compacted before the others come.

    Trips arrive in stretches of their order, the last one first, so that batches lie behind what is
    stored; the samples of one trip in four are dealt out at random, which interleaves it.
    """

    def query(spark, sf_dir):
        positions = _positions(spark, sf_dir, grain)
        last = positions.agg(F.max("ct")).first()[0] or 0
        stretch = F.lit(3) - F.floor(F.col("ct") * 4 / (last + 1))
        dealt = F.pmod(F.xxhash64("ts", "ct"), F.lit(4))
        number = F.when(F.col("trip_id") == 1, dealt).otherwise(F.coalesce(stretch, dealt))
        states, compacted = (scratch_path(spark, "states") for _ in range(2))
        for at in range(4):
            target = states if at < 2 else compacted
            add_batch(positions.filter(number == at), grain, target, f"b{at}")
        compact_states(spark, states, compacted, grain)
        return stat_from_states(positions, grain, compacted)

    return query


def load_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each run over the samples did, with the number of days in the table after it."""
    positions = event_positions(spark, sf_dir)
    asked = [INCREMENTAL, INCREMENTAL, INCREMENTAL, FULL_LOAD, "X"]
    found = []

    def runs(target, table):
        for run, mode in enumerate(asked):
            arrived = positions if run else _until(positions, DAY)
            try:
                ran = refresh(arrived, DAY, target, table, mode) or "NOTHING_NEW"
            except ValueError:
                ran = "REFUSED"
            found.append((run, ran, spark.table(table).count()))

    _in_gold(spark, runs)
    return spark.createDataFrame(found, "run int, load_type string, days bigint")


def scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental scan of a table partitioned on disk, where whole directories are skipped."""
    source = scratch_path(spark, "silver")
    write_partitioned(event_positions(spark, sf_dir), DAY.partitions, source, "overwrite")
    return read_positions(spark, source, DAY, WATERMARKS["day"])


def entry(spark: SparkSession) -> DataFrame:
    """Hourly driving statistics."""
    return stats(HOUR)(spark, "/root/testdata/sf0.001")


def _corpus() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the corpus operators and their pipeline; none where they are not there."""
    try:
        from tripgrain.llm.queries import ORACLES, QUERIES
    except ImportError:
        return {}, {}
    named, oracles = dict(QUERIES), dict(ORACLES)
    if importlib.util.find_spec("corpus_pipeline") is not None:
        import corpus_pipeline

        named["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL is not None:
            oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return named, oracles


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        "scan_full": scan_full,
        "scan_partitioned": scan_partitioned,
        "position_projection": position_projection,
        "time_columns": time_columns,
        "year_month": year_month_text,
        "driving_minutes": driving_minutes_per_day,
        "ordered_trace_hot_groups": traces_hot_groups,
        "trip_distance_hot_groups": distances_hot_groups,
        "driving_events_hot_groups": events_hot_groups,
        "hourly_stat": stats(HOUR),
        "daily_stat": stats(DAY),
        "daily_stat_hot_groups": daily_stat_hot_groups,
        "daily_stat_thresholds": daily_stat_thresholds,
        "hourly_stat_text_ts": hourly_stat_text_ts,
        "refresh_shifted_day": refresh_shifted,
        "refresh_repaired_day": refresh_repaired,
        "load_modes": load_modes,
        "monthly_stat": stats(MONTH),
        "monthly_stat_collapsed": monthly_stat_collapsed,
        "write_overwrite": write_overwrite,
        "write_append": write_append,
        "write_published": write_published,
        "catalog_partitions": catalog_partitions,
    }
    per_grain = {
        "partition_timestamp": partition_timestamps,
        "scan_incremental": scan_incremental,
        "latest_partition": latest,
        "latest_partition_sql": latest_by_sql,
        "latest_partition_listed": latest_by_listing,
        "trip_agg": trips,
        "ordered_trace": traces,
        "trip_distance": distances,
        "bucket_rollup": rollups,
        "trip_averages": averages,
        "partition_paths": paths,
        "refresh_incremental": refreshed,
        "stat_from_states": from_states,
    }
    for grain in GRAINS.values():
        for name, build in per_grain.items():
            named[f"{name}_{grain.name}"] = build(grain)
        if grain.has_events:
            named[f"driving_events_{grain.name}"] = events(grain)
            named[f"attach_events_{grain.name}"] = trips_with_events(grain)
    return named | _corpus()[0]


# --- the same in SQL ---------------------------------------------------------------------------

EVENT_POSITIONS_SQL = """
    select user_id % 4 as trip_id, user_id, user_id % 7 as vehicle_id, ts,
           cast(35.0 as double) + (event_id % 97) / cast(1000.0 as double) as latitude,
           cast(139.0 as double) + (event_id % 89) / cast(1000.0 as double) as longitude,
           event_id as ct, value % 120 as sp,
           cast(year(ts) as int) as year, cast(month(ts) as int) as month,
           cast(day(ts) as int) as day, cast(hour(ts) as int) as hour
    from events"""

ORDER_POSITIONS_SQL = """
    select o_custkey % 4 as trip_id, o_custkey as user_id, o_custkey % 7 as vehicle_id,
           o_orderdate as ts,
           cast(35.0 as double) + (o_orderkey % 97) / cast(1000.0 as double) as latitude,
           cast(139.0 as double) + (o_orderkey % 89) / cast(1000.0 as double) as longitude,
           o_orderkey as ct, round(o_totalprice % 120, 2) as sp,
           cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
           cast(day(o_orderdate) as int) as day, cast(hour(o_orderdate) as int) as hour
    from orders"""


GREAT_CIRCLE_SQL = """2 * 6371000.0 * asin(sqrt(least(1.0,
                       pow(sin(radians(latitude - lat1) / 2), 2)
                       + cos(radians(lat1)) * cos(radians(latitude))
                         * pow(sin(radians(longitude - lon1) / 2), 2))))"""
STRAIGHT_SQL = "(abs(latitude - lat1) + abs(longitude - lon1)) * 100000.0"


def _ctes(
    grain: Grain, step: str = GREAT_CIRCLE_SQL, stop: str = "5", harsh: str = "10"
) -> str:
    """Positions, the steps between them, and trips measured by steps."""
    bucket = grain.name
    keys = f"date, {bucket}, trip_id"
    positions = ORDER_POSITIONS_SQL if grain is MONTH else EVENT_POSITIONS_SQL
    return f"""
    with positions as ({positions}),
    samples as (
        select cast(ts as date) as date, {bucket}, trip_id, user_id, vehicle_id, ts,
               latitude, longitude, ct, round(sp, 2) as sp
        from positions),
    neighbours as (
        select *, lag(latitude) over w as lat1, lag(longitude) over w as lon1,
               lag(ct) over w as ct1, lag(sp) over w as sp1
        from samples
        window w as (partition by {keys} order by ct, ts, latitude, longitude, sp)),
    steps as (
        select *,
               case when lat1 is null then 0.0 else {step} end as metres,
               case when ct > ct1 then (sp - sp1) / (ct - ct1) end as change
        from neighbours),
    trips as (
        select {keys},
               count(distinct user_id) as user_count,
               count(distinct vehicle_id) as vehicle_count,
               count(ct) as total_driving_time,
               count(latitude) as size_of_latitude,
               cast(round(sum(metres)) as bigint) as total_distance,
               count(*) filter (sp1 <= {stop} and change >= {harsh}) as total_sudden_start_count,
               count(*) filter (sp <= {stop} and change <= -{harsh}) as total_sudden_stop_count,
               count(*) filter (sp1 > {stop} and change >= {harsh}) as total_acceleration_count,
               count(*) filter (sp > {stop} and change <= -{harsh}) as total_deceleration_count
        from steps group by {keys})"""


def _sum_list(grain: Grain) -> str:
    return ", ".join(f"cast(sum({total}) as bigint) as {total}" for total in grain.trip_totals)


def _rollup_sql(grain: Grain, *formulas: str) -> str:
    return f"""{_ctes(grain, *formulas)},
    buckets as (
        select date, {grain.name}, count(distinct trip_id) as trip_count, {_sum_list(grain)}
        from trips group by date, {grain.name})"""


def _average_list(grain: Grain) -> str:
    return ", ".join(
        f"{total} / cast(trip_count as double) as {average}"
        for average, total in grain.averaged.items()
    )


MINUTES_SQL = "cast(round(total_driving_time / cast(60 as double)) as bigint)"


def _stat_sql(grain: Grain, *formulas: str) -> str:
    bucket = grain.name
    extra = {
        "hour": """cast(year(date) as int) as year, cast(month(date) as int) as month,
                   cast(day(date) as int) as day""",
        "day": """cast(year(date) as int) as year, cast(month(date) as int) as month,
                  concat(year(date), month(date)) as year_month""",
        "month": """cast(year(date) as int) as year,
                    concat(year(date), month(date)) as year_month""",
    }[bucket]
    dated = "* exclude (date)" if grain is MONTH else "*"
    return f"""{_rollup_sql(grain, *formulas)},
    minutes as (
        select * replace ({MINUTES_SQL} as total_driving_time) from buckets)
    select {dated}, {extra}, {_average_list(grain)} from minutes"""


def _trace_sql(grain: Grain, piece_rows: int) -> str:
    keys = ", ".join(grain.trip_keys)
    return f"""{_ctes(grain)},
    ranked as (
        select *, row_number() over (
            partition by {keys} order by ct, ts, latitude, longitude, sp) - 1 as pos
        from samples)
    select {keys}, pos // {piece_rows} as piece, cast(count(*) as int) as samples,
           string_agg(cast(ct as varchar) || ':' || cast(latitude as varchar), ','
                      order by pos) as trace
    from ranked group by {keys}, pos // {piece_rows}"""


def oracle_sql() -> dict[str, str]:
    counts = ", ".join(EVENT_COUNTS)
    trip_columns = "user_count, vehicle_count, total_driving_time, size_of_latitude"
    day_keys = ", ".join(DAY.trip_keys)
    whole_day = _stat_sql(DAY)
    after_day = f"""{_ctes(DAY)} select * from positions
        where (year, month, day) > (2024, 1, 15)"""
    named = {
        "scan_full": EVENT_POSITIONS_SQL,
        "scan_partitioned": after_day,
        "position_projection": f"""select {", ".join(POSITION_COLUMNS)}
            from ({EVENT_POSITIONS_SQL})""",
        "time_columns": f"""select ct, date_trunc('second', ts) as ts, cast(ts as date) as date,
            year, month, day, hour from ({EVENT_POSITIONS_SQL})""",
        "year_month": f"""select ct, concat(year, month) as year_month
            from ({ORDER_POSITIONS_SQL})""",
        "driving_minutes": f"""{_rollup_sql(DAY)}
            select date, day, {MINUTES_SQL} as total_driving_time from buckets""",
        "ordered_trace_hot_groups": _trace_sql(DAY, 50),
        "trip_distance_hot_groups": f"""{_ctes(DAY)}
            select {day_keys}, total_distance from trips""",
        "driving_events_hot_groups": f"{_ctes(DAY)} select {day_keys}, {counts} from trips",
        "hourly_stat": _stat_sql(HOUR),
        "daily_stat": whole_day,
        "daily_stat_hot_groups": whole_day,
        "daily_stat_thresholds": _stat_sql(DAY, STRAIGHT_SQL, "40", "3.5"),
        "hourly_stat_text_ts": _stat_sql(HOUR),
        "refresh_shifted_day": whole_day,
        "refresh_repaired_day": whole_day,
        "load_modes": f"""
            with days as (
                select count(distinct ts::date) as total,
                       count(distinct ts::date) filter (ts < '2024-01-16') as early
                from ({EVENT_POSITIONS_SQL}))
            select cast(run as int) as run, load_type,
                   case when run = 0 then early else total end as days
            from days, (values (0, 'FULL_LOAD'), (1, 'INCREMENTAL'), (2, 'NOTHING_NEW'),
                               (3, 'FULL_LOAD'), (4, 'REFUSED')) as runs(run, load_type)""",
        "monthly_stat": _stat_sql(MONTH),
        "monthly_stat_collapsed": f"""{_ctes(MONTH)},
            months as (
                select cast(year(date) as int) as year, month,
                       count(distinct trip_id) as trip_count, {_sum_list(MONTH)}
                from trips group by all)
            select * replace ({MINUTES_SQL} as total_driving_time),
                   concat(year, month) as year_month, {_average_list(MONTH)}
            from months""",
        "write_overwrite": whole_day,
        "write_append": whole_day,
        "write_published": whole_day,
        "catalog_partitions": f"""select distinct
            'year=' || year || '/month=' || month || '/day=' || day as partition
            from ({EVENT_POSITIONS_SQL})""",
    }
    later = {
        "hour": "(year, month, day, hour) > (2024, 1, 15, 12)",
        "day": "(year, month, day) > (2024, 1, 15)",
        "month": "(year, month) > (1998, 6)",
    }
    start = {
        "hour": "make_timestamp(year, month, day, hour, 0, 0)",
        "day": "make_timestamp(year, month, day, 0, 0, 0)",
        "month": "make_timestamp(year, month, 1, 0, 0, 0)",
    }
    for name, grain in GRAINS.items():
        keys, parts = ", ".join(grain.trip_keys), ", ".join(grain.partitions)
        path = " || ".join(f"'{part}=' || {part} || '/'" for part in grain.partitions)
        ctes = _ctes(grain)
        latest_sql = f"""{ctes}
            select {parts}, {start[name]} as latest_ts from positions
            order by {", ".join(f"{part} desc" for part in grain.partitions)} limit 1"""
        named |= {
            f"partition_timestamp_{name}": f"""{ctes}
                select distinct {parts}, {start[name]} as partition_ts from positions""",
            f"scan_incremental_{name}": f"{ctes} select * from positions where {later[name]}",
            f"latest_partition_{name}": latest_sql,
            f"latest_partition_sql_{name}": latest_sql,
            f"latest_partition_listed_{name}": latest_sql,
            f"trip_agg_{name}": f"{ctes} select {keys}, {trip_columns} from trips",
            f"ordered_trace_{name}": _trace_sql(grain, 10_000),
            f"trip_distance_{name}": f"{ctes} select {keys}, total_distance from trips",
            f"bucket_rollup_{name}": f"{_rollup_sql(grain)} select * from buckets",
            f"trip_averages_{name}": f"""{_rollup_sql(grain)},
                minutes as (
                    select * replace ({MINUTES_SQL} as total_driving_time) from buckets)
                select {", ".join(grain.bucket_keys)}, {_average_list(grain)} from minutes""",
            f"partition_paths_{name}": f"""{ctes}
                select distinct {path} as partition_path from positions""",
            f"refresh_incremental_{name}": _stat_sql(grain),
            f"stat_from_states_{name}": _stat_sql(grain),
        }
        if grain.has_events:
            named |= {
                f"driving_events_{name}": f"{ctes} select {keys}, {counts} from trips",
                f"attach_events_{name}": f"""{ctes}
                    select {keys}, {trip_columns}, {counts} from trips""",
            }
    return named | _corpus()[1]
