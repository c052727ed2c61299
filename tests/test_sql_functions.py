import pytest
from fixtures import frame, mixed_samples
from pyspark.sql import functions as F
from tripgrain.functions.sql import register_functions, trip_motion_sql
from tripgrain.functions.timestamps import with_bucket
from tripgrain.operators.trips import driving_events, trip_distance
from tripgrain.schema import DAY, EVENT_COUNTS, HOUR


@pytest.mark.parametrize("grain", [HOUR, DAY], ids=["hour", "day"])
def test_pure_sql_equals_the_operators(spark, grain):
    register_functions(spark)
    register_functions(spark)
    positions = frame(spark, mixed_samples())
    positions.createOrReplaceTempView("sql_positions")
    samples = with_bucket(positions, grain)
    keys = grain.trip_keys

    def rows(table, names):
        return sorted(map(tuple, table.select(*keys, *[F.col(n).cast("long") for n in names]).collect()), key=repr)

    found = spark.sql(trip_motion_sql("sql_positions", grain.name))
    assert rows(found, ["total_distance"]) == rows(trip_distance(samples, keys), ["total_distance"])
    assert rows(found, EVENT_COUNTS) == rows(driving_events(samples, keys), EVENT_COUNTS)
