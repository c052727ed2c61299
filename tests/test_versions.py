import pytest
from pyspark.sql import functions as F
from tripgrain.durable import scratch_path
from tripgrain.sinks.versions import (
    APPEND,
    OVERWRITE,
    REPLACE,
    PublicationConflict,
    commit,
    latest_version,
    publish,
    read_published,
    stage,
)

KIND = "n int, year int, month int"
PARTS = ("year", "month")
OLD = [(1, 2024, 1), (2, 2024, 2), (3, None, None)]
NEW = [(4, 2024, 2), (5, 2024, 3), (6, None, None)]


@pytest.fixture
def path(spark):
    return scratch_path(spark, "versions")


def frame(spark, rows):
    return spark.createDataFrame(rows, KIND)


def rows(table):
    return sorted(map(tuple, table.select("n", *PARTS).collect()))


def seen(spark, path, number=None):
    return rows(read_published(spark, path, PARTS, number))


@pytest.mark.parametrize(
    "mode, expected", [(OVERWRITE, NEW), (APPEND, OLD + NEW), (REPLACE, [OLD[0], *NEW])]
)
def test_modes_and_snapshots(spark, path, mode, expected):
    assert publish(frame(spark, OLD), PARTS, path, mode) == 1
    began = read_published(spark, path, PARTS)
    assert publish(frame(spark, NEW), PARTS, path, mode) == latest_version(spark, path) == 2
    assert rows(began) == seen(spark, path, 1) == sorted(OLD)
    assert seen(spark, path) == sorted(expected)


def test_a_lost_writer_leaves_the_old_table(spark, path):
    publish(frame(spark, OLD), PARTS, path, OVERWRITE)
    # Lost after its rows were stored, and lost in the middle of writing them.
    stage(frame(spark, NEW), PARTS, path)
    assert seen(spark, path) == sorted(OLD)
    breaking = frame(spark, NEW).withColumn(
        "n", F.when(F.col("n") == 5, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("n"))
    )
    with pytest.raises(Exception, match="lost"):
        publish(breaking, PARTS, path, REPLACE)
    assert seen(spark, path) == sorted(OLD)
    publish(frame(spark, NEW), PARTS, path, REPLACE)
    assert seen(spark, path) == sorted([OLD[0], *NEW])


def test_of_two_writers_on_one_version_the_second_is_refused(spark, path):
    publish(frame(spark, OLD), PARTS, path, OVERWRITE)
    one, other = stage(frame(spark, NEW), PARTS, path), stage(frame(spark, [(9, 2024, 1)]), PARTS, path)
    assert commit(spark, path, PARTS, one, REPLACE, 1) == 2
    with pytest.raises(PublicationConflict):
        commit(spark, path, PARTS, other, REPLACE, 1)
    assert seen(spark, path) == sorted([OLD[0], *NEW])
    # On top of what the first one published it goes through.
    assert commit(spark, path, PARTS, other, REPLACE, 2) == 3
    assert seen(spark, path) == sorted([(9, 2024, 1), *NEW])


def test_empty_and_unknown(spark, path):
    with pytest.raises(ValueError):
        read_published(spark, path, PARTS)
    publish(frame(spark, OLD), PARTS, path, OVERWRITE)
    publish(frame(spark, []), PARTS, path, REPLACE)
    assert seen(spark, path) == sorted(OLD)
    publish(frame(spark, []), PARTS, path, OVERWRITE)
    assert seen(spark, path) == []
    with pytest.raises(ValueError):
        publish(frame(spark, OLD), PARTS, path, "merge")


def test_other_versions_are_not_read(spark, path):
    for table in (OLD, NEW):
        publish(frame(spark, table), PARTS, path, OVERWRITE)
    plan = read_published(spark, path, PARTS)._jdf.queryExecution().executedPlan().toString()
    assert "version" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
