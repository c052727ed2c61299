from datetime import date, datetime

from pyspark.sql import functions as F

from fixtures import frame, sample
from tripgrain.functions.timestamps import (
    parse_timestamp,
    partition_timestamp,
    with_bucket,
    with_time_columns,
    year_month,
)
from tripgrain.schema import DAY, HOUR, MONTH

TEXTS = [
    "2024-01-05 03:00:01",
    "2024-1-5 3:0:1",
    "2024-01-05 03:00:01.5",
    "2024-01-05 03:00:01 UTC",
    "2024-01-05T03:00:01",
    "2024-02-30 00:00:00",
    "2024-01-05 25:00:00",
    "2024-01-05 03:00:60",
    " 2024-01-05 03:00:01",
    "2024-01-05  03:00:01",
    "2024- 1- 5 03:00:01",
    "2024-01-05 03:00",
    "2024-01-05",
    "x",
    "",
    None,
]


def test_text_is_read_as_by_the_legacy_parser(spark):
    texts = spark.createDataFrame([(text,) for text in TEXTS], "text string")
    ours = texts.select("text", parse_timestamp(F.col("text")).cast("string").alias("ts")).collect()
    settings = {"spark.sql.legacy.timeParserPolicy": "LEGACY", "spark.sql.ansi.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        legacy = F.to_timestamp("text", "yyyy-MM-dd HH:mm:ss")
        expected = texts.select("text", legacy.cast("string").alias("ts")).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert ours == expected
    assert ours[0]["ts"] == "2024-01-05 03:00:01" and ours[-1]["ts"] is None


def test_text_and_timestamps_give_the_same_columns(spark):
    typed = frame(spark, [sample(ts=datetime(2024, 1, 5, 23, 59, 59))])
    text = typed.withColumn("ts", F.col("ts").cast("string"))
    for frame_ in (typed, text):
        row = with_time_columns(frame_).select("date", "year", "month", "day", "hour").first()
        assert tuple(row) == (date(2024, 1, 5), 2024, 1, 5, 23)


def test_bucket_columns_follow_the_grain(spark):
    positions = frame(spark, [sample()])
    for grain, value in ((HOUR, 10), (DAY, 5), (MONTH, 1)):
        row = with_bucket(positions, grain).select(*grain.bucket_keys).first()
        assert tuple(row) == (date(2024, 1, 5), value)


def test_year_month_is_not_padded(spark):
    row = spark.range(1).select(
        year_month(F.lit(2024), F.lit(1)).alias("a"), year_month(F.lit(2024), F.lit(11)).alias("b")
    )
    assert tuple(row.first()) == ("20241", "202411")


def test_partition_timestamp_fills_absent_parts(spark):
    parts = spark.createDataFrame([(2024, 3, 9, 7)], "year int, month int, day int, hour int")
    starts = [parts.select(partition_timestamp(grain)).first()[0] for grain in (HOUR, DAY, MONTH)]
    assert starts == [datetime(2024, 3, 9, 7), datetime(2024, 3, 9), datetime(2024, 3, 1)]
