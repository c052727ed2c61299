"""Statistics merged from stored states of batches, against the statistic of all samples."""

import random

import pytest

from fixtures import frame, mixed_samples, sample
from tripgrain.durable import scratch_path
from tripgrain.operators.trip_state import state_trips
from tripgrain.plans.states import add_batch, compact_states, read_states, stat_from_states
from tripgrain.plans.statistics import driving_stat
from tripgrain.schema import DAY, GRAINS, HOUR, POSITION_COLUMNS


def in_batches(samples, cut, seed):
    """Samples at random, or in ranges of their order that meet in ties, in shuffled order."""
    chance, batches = random.Random(seed), [[], [], [], []]
    bounds = sorted(chance.sample(range(300), 3))
    ct = POSITION_COLUMNS.index("ct")
    for row in samples:
        at = chance.randrange(4) if cut == "random" else sum(row[ct] > bound for bound in bounds)
        batches[at].append(row)
    chance.shuffle(batches)
    return batches


def stored(spark, batches, grain, max_group_rows=None):
    path = scratch_path(spark, "states")
    for number, rows in enumerate(batches):
        add_batch(frame(spark, rows), grain, path, f"b{number}", max_group_rows)
    return path


def same(one, other):
    return sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))


@pytest.mark.parametrize(
    "grain, cut, limit",
    [("hour", "ranges", None), ("day", "random", 60), ("month", "ranges", 60), ("month", "random", None)],
)
def test_merged_states_equal_the_statistic(spark, grain, cut, limit):
    grain, samples = GRAINS[grain], mixed_samples(seed=3, rows=700)
    everything = frame(spark, samples)
    path = stored(spark, in_batches(samples, cut, seed=5), grain, limit)
    expected = driving_stat(everything, grain)
    assert same(stat_from_states(everything, grain, path, limit), expected)
    compacted = scratch_path(spark, "states")
    compact_states(spark, path, compacted, grain)
    assert same(stat_from_states(everything, grain, compacted, limit), expected)


def test_batches_in_ranges_read_no_samples_again(spark):
    samples = mixed_samples(seed=4, rows=500)
    path = stored(spark, in_batches(samples, "ranges", seed=6), DAY)
    assert state_trips(read_states(spark, path), DAY).filter("interleaved").isEmpty()
    none = frame(spark, [])
    assert same(stat_from_states(none, DAY, path), driving_stat(frame(spark, samples), DAY))


def test_repeated_batch_takes_its_own_place(spark):
    rows = [sample(ct=n, lat=35 + n / 100) for n in range(6)]
    path = stored(spark, [rows[3:], rows[:3]], HOUR)
    add_batch(frame(spark, rows[3:]), HOUR, path, "b0")
    assert same(stat_from_states(frame(spark, []), HOUR, path), driving_stat(frame(spark, rows), HOUR))


def test_a_position_before_the_batch_is_bridged(spark):
    rows = [sample(ct=0, lat=35.0), sample(ct=1, lat=None), sample(ct=2, lat=35.5)]
    path = stored(spark, [rows[2:], rows[:1], rows[1:2]], DAY)
    row = stat_from_states(frame(spark, []), DAY, path).first()
    assert row["total_distance"] == 55597


def test_empty_batches_give_no_rows(spark):
    path = stored(spark, [[], []], DAY)
    assert stat_from_states(frame(spark, []), DAY, path).count() == 0


def test_only_the_sources_of_overlapping_trips_are_read(spark):
    rows = [sample(ct=n) for n in range(8)] + [sample(trip="b", ct=n) for n in range(4)]
    parts = ["2024 as year", "1 as month"]
    everything = frame(spark, rows).selectExpr("*", *parts, "5 as day")
    path = scratch_path(spark, "states")
    for number in range(2):
        add_batch(everything.filter(f"ct % 2 = {number}"), DAY, path, f"b{number}")
    # A sample that no batch held, in a partition that fed none of them.
    other = frame(spark, [sample(ct=3, sp=90.0)]).selectExpr("*", *parts, "9 as day")
    found = stat_from_states(everything.unionByName(other), DAY, path)
    assert same(found, driving_stat(everything, DAY))


def test_batch_names_are_checked(spark):
    with pytest.raises(ValueError):
        add_batch(frame(spark, []), DAY, scratch_path(spark, "states"), "a/b")
