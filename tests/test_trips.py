from datetime import timedelta

import pytest

from fixtures import (
    START,
    distance_by_hand,
    events_by_hand,
    frame,
    groups_by_hand,
    mixed_samples,
    sample,
)
from tripgrain.functions.timestamps import with_bucket
from tripgrain.operators import skew
from tripgrain.operators.rollup import bucket_rollup
from tripgrain.operators.traces import ordered_trace
from tripgrain.operators.trips import (
    attach_events,
    driving_events,
    trip_agg,
    trip_distance,
    trip_rows,
)
from tripgrain.schema import DAY, EVENT_COUNTS, HOUR, MONTH

# Row limits that leave all groups whole, split some, and split every group.
LIMITS = [None, 60, 1]


def by_trip(df, *columns):
    return {row["trip_id"]: tuple(row[name] for name in columns) for row in df.collect()}


def distance(spark, samples, limit=None):
    buckets = with_bucket(frame(spark, samples), DAY)
    return by_trip(trip_distance(buckets, DAY.trip_keys, limit), "total_distance")["a"][0]


@pytest.mark.parametrize("limit", [None, 1])
def test_distance_of_known_paths(spark, limit):
    assert distance(spark, [sample()], limit) == 0
    assert distance(spark, [sample(ct=0), sample(ct=1, lat=36.0)], limit) == 111_195
    bridged = [sample(ct=0), sample(ct=1, lat=None, lon=None), sample(ct=2, lat=36.0)]
    assert distance(spark, bridged, limit) == 111_195
    half_known = [sample(ct=0), sample(ct=1, lat=80.0, lon=None), sample(ct=2, lat=36.0)]
    assert distance(spark, half_known, limit) == 111_195
    for odd in (float("nan"), float("inf")):
        odd_one = [sample(ct=0), sample(ct=1, lat=odd), sample(ct=2, lat=36.0)]
        assert distance(spark, odd_one, limit) == 111_195
    assert distance(spark, [sample(lat=None, lon=None, ct=n) for n in range(3)], limit) == 0
    there_and_back = [sample(ct=n, lat=35.0 + n % 2) for n in (2, 0, 1)]
    assert distance(spark, there_and_back, limit) == 222_390


@pytest.mark.parametrize("limit", [None, 1])
def test_events_at_and_below_each_threshold(spark, limit):
    steps = {
        "start": (5.0, 15.0, (1, 0, 0, 0)),
        "start below": (5.0, 14.99, (0, 0, 0, 0)),
        "stop": (15.0, 5.0, (0, 1, 0, 0)),
        "stop below": (14.99, 5.0, (0, 0, 0, 0)),
        "acceleration": (5.01, 15.01, (0, 0, 1, 0)),
        "acceleration below": (5.01, 15.0, (0, 0, 0, 0)),
        "deceleration": (15.01, 5.01, (0, 0, 0, 1)),
        "deceleration below": (15.0, 5.01, (0, 0, 0, 0)),
        "rounded up to the threshold": (5.0, 14.996, (1, 0, 0, 0)),
        "unknown": (None, 80.0, (0, 0, 0, 0)),
        "not a number": (0.0, float("nan"), (0, 0, 0, 0)),
    }
    samples = [
        sample(trip=trip, ct=ct, sp=sp)
        for trip, (was, now, _) in steps.items()
        for ct, sp in ((0, was), (1, now))
    ]
    samples += [sample(trip="slow", ct=ct, sp=sp) for ct, sp in ((0, 0.0), (2, 19.9))]
    samples += [sample(trip="same ct", ct=3, sp=sp) for sp in (0.0, 90.0)]
    buckets = with_bucket(frame(spark, samples), DAY)
    events = driving_events(buckets, DAY.trip_keys, max_group_rows=limit)
    found = by_trip(events, *EVENT_COUNTS)
    for trip, (_, _, expected) in steps.items():
        assert found[trip] == expected, trip
    assert found["slow"] == found["same ct"] == (0, 0, 0, 0)


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("seed", [7, 8])
def test_motion_matches_brute_force(spark, limit, seed):
    samples = mixed_samples(seed)
    expected = groups_by_hand(samples, lambda row: (row["ts"].date(), row["trip_id"]))
    buckets = with_bucket(frame(spark, samples), DAY)
    distances = trip_distance(buckets, DAY.trip_keys, limit).collect()
    assert len(distances) == len(expected)
    for row in distances:
        assert row["total_distance"] == distance_by_hand(expected[row["date"], row["trip_id"]])
    events = driving_events(buckets, DAY.trip_keys, max_group_rows=limit).collect()
    assert len(events) == len(expected)
    for row in events:
        by_hand = events_by_hand(expected[row["date"], row["trip_id"]])
        assert tuple(row[name] for name in EVENT_COUNTS) == by_hand


@pytest.mark.parametrize("limit", LIMITS)
def test_traces_hold_every_sample_in_order(spark, limit):
    samples = mixed_samples()
    expected = groups_by_hand(samples, lambda row: (row["ts"].date(), row["trip_id"]))
    pieces = ordered_trace(
        with_bucket(frame(spark, samples), DAY), DAY.trip_keys, piece_rows=7, max_group_rows=limit
    )
    found = {}
    for row in sorted(pieces.collect(), key=lambda row: row["piece"]):
        assert len(row["trace"]) <= 7
        found.setdefault((row["date"], row["trip_id"]), []).extend(map(tuple, row["trace"]))
    order = ("ct", "ts", "latitude", "longitude", "sp")
    assert found == {
        key: [tuple(row[name] for name in order) for row in rows]
        for key, rows in expected.items()
    }


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("grain", [HOUR, DAY, MONTH])
def test_trip_rows_match_brute_force(spark, grain, limit):
    samples = mixed_samples()
    expected = groups_by_hand(
        samples, lambda row: (row["ts"].date(), getattr(row["ts"], grain.name), row["trip_id"])
    )
    if grain.has_events:
        expected = {key: rows for key, rows in expected.items() if key[2] is not None}
    found = trip_rows(with_bucket(frame(spark, samples), grain), grain, limit).collect()
    assert len(found) == len(expected)
    for row in found:
        rows = expected[row["date"], row[grain.name], row["trip_id"]]
        assert row["user_count"] == len({r["user_id"] for r in rows} - {None})
        assert row["vehicle_count"] == len({r["vehicle_id"] for r in rows} - {None})
        assert row["total_driving_time"] == len(rows)
        assert row["total_distance"] == distance_by_hand(rows)
        if grain.has_events:
            assert tuple(row[name] for name in EVENT_COUNTS) == events_by_hand(rows)


def test_hot_groups_are_exactly_those_above_the_limit(spark):
    samples = with_bucket(frame(spark, mixed_samples()), DAY)
    sizes = {
        (row["date"], row["trip_id"]): row["count"]
        for row in samples.groupBy(*DAY.trip_keys).count().collect()
    }
    hot = skew.find_hot_groups(samples, DAY.trip_keys, 60)
    found = {(row["date"], row["trip_id"]): row["rows"] for row in hot.groups.collect()}
    assert found == {key: rows for key, rows in sizes.items() if rows > 60}
    assert hot.tiles == -(-sum(found.values()) // 60)
    assert skew.find_hot_groups(samples, DAY.trip_keys, max(sizes.values())) is None


def test_many_tiles_in_few_partitions(spark):
    """Tiles hold the limit at most and follow the order; partitions do not grow with the tiles."""
    samples = with_bucket(frame(spark, mixed_samples()), DAY)
    hot = skew.find_hot_groups(samples, DAY.trip_keys, 3)
    order = [*DAY.trip_keys, *skew.SAMPLE_ORDER]
    rows = hot.select_from(samples, DAY.trip_keys, "left_semi").select(*order).distinct()
    tiled = skew.with_tiles(rows, DAY.trip_keys, hot)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert hot.tiles > 10 * partitions and tiled.rdd.getNumPartitions() <= partitions
    found = tiled.orderBy(*order).select("tile").collect()
    tiles = [row["tile"] for row in found]
    assert tiles == sorted(tiles) and len(tiles) == rows.count()
    assert max(tiles.count(tile) for tile in set(tiles)) <= 3
    assert len(set(tiles)) <= hot.tiles + 2 * partitions


def test_more_hot_groups_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_BROADCAST_ROWS", 2)
    samples = with_bucket(frame(spark, mixed_samples()), DAY)
    split = trip_distance(samples, DAY.trip_keys, 1).collect()
    assert sorted(split, key=repr) == sorted(
        trip_distance(samples, DAY.trip_keys).collect(), key=repr
    )


def test_trip_aggregate_counts_known_values(spark):
    samples = [
        sample(user=1, vehicle=1, ct=1),
        sample(user=2, vehicle=1, ct=2, lat=None),
        sample(user=None, vehicle=None, ct=None),
    ]
    trips = trip_agg(with_bucket(frame(spark, samples), DAY), DAY.trip_keys)
    columns = ("user_count", "vehicle_count", "total_driving_time", "size_of_latitude")
    assert by_trip(trips, *columns) == {"a": (2, 1, 2, 2)}
    # A hot trip may have more samples than an int can count.
    assert all(dict(trips.dtypes)[name] == "bigint" for name in columns)


def test_input_order_does_not_matter(spark):
    samples = mixed_samples(rows=400)
    answers = {
        repr(
            sorted(
                trip_rows(with_bucket(frame(spark, rows), HOUR), HOUR).collect(), key=repr
            )
        )
        for rows in (samples, samples[::-1], sorted(samples, key=repr))
    }
    assert len(answers) == 1


def test_segments_do_not_cross_bucket_edges(spark):
    samples = [
        sample(ct=0, ts=START - timedelta(seconds=1)),
        sample(ct=1, ts=START, lat=36.0),
        sample(ct=2, ts=START + timedelta(days=1), lat=37.0),
    ]
    for grain, expected in ((HOUR, [0, 0, 0]), (DAY, [0, 111_195])):
        trips = trip_distance(with_bucket(frame(spark, samples), grain), grain.trip_keys)
        assert sorted(row["total_distance"] for row in trips.collect()) == expected


def test_hours_add_up_to_days(spark):
    positions = frame(spark, mixed_samples())
    hours = bucket_rollup(trip_rows(with_bucket(positions, HOUR), HOUR), HOUR)
    days = bucket_rollup(trip_rows(with_bucket(positions, DAY), DAY), DAY)
    sums = hours.groupBy("date").sum("total_driving_time", "total_distance").collect()
    by_day = {row["date"]: row for row in days.collect()}
    assert len(sums) == len(by_day)
    for row in sums:
        day = by_day[row["date"]]
        assert row["sum(total_driving_time)"] == day["total_driving_time"]
        assert row["sum(total_distance)"] <= day["total_distance"]


def test_join_drops_null_keys(spark):
    samples = with_bucket(frame(spark, [sample(), sample(trip=None)]), DAY)
    keys = DAY.trip_keys
    joined = attach_events(trip_agg(samples, keys), driving_events(samples, keys), keys)
    assert [row["trip_id"] for row in joined.collect()] == ["a"]


def test_join_reuses_the_partitioning_of_both_sides(spark):
    samples = with_bucket(frame(spark, [sample()]), HOUR)
    keys = HOUR.trip_keys
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trips, events = trip_agg(samples, keys), driving_events(samples, keys)
        plans = [
            df._jdf.queryExecution().executedPlan().toString()
            for df in (attach_events(trips, events, keys), trips, events)
        ]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffles = [plan.count("Exchange hashpartitioning") for plan in plans]
    assert "SortMergeJoin" in plans[0] and shuffles[0] == shuffles[1] + shuffles[2]
