"""Time parsing, calendar parts and partition timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.schema import Grain

# The text format of `ts`, and the same fields without padding.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
TS_LOOSE_FORMAT = "y-M-d H:m:s"
TS_LOOSE_PREFIX = r"^[ \t]*(\d+-[ \t]*\d+-[ \t]*\d+[ \t]+\d+:[ \t]*\d+:[ \t]*\d+)"


def parse_timestamp(text: Column) -> Column:
    """Text to timestamp; NULL where there is no `yyyy-MM-dd HH:mm:ss`.

    Unpadded fields, blanks before a field and text after the seconds (fractions, zone names) are
    accepted, as Spark's legacy time parser does. The loose branch runs only for rows the plain
    format rejects.
    """
    prefix = F.regexp_extract(text, TS_LOOSE_PREFIX, 1)
    tidy = F.regexp_replace(F.regexp_replace(prefix, r"([-:])[ \t]+", "$1"), r"[ \t]+", " ")
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(TS_FORMAT)),
        F.try_to_timestamp(tidy, F.lit(TS_LOOSE_FORMAT)),
    )


def with_parsed_ts(df: DataFrame) -> DataFrame:
    """Parse `ts` where it is text; a timestamp column is left as it is.

    The result comes out of a one-row generator, below which no filter on it or on what derives
    from it is pushed. Otherwise each such filter would carry a parse of its own.
    """
    if df.schema["ts"].dataType.typeName() in ("string", "varchar", "char"):
        return df.withColumn("ts", F.explode(F.array(parse_timestamp(F.col("ts")))))
    return df


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "date": F.to_date(ts),
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    }


def with_time_columns(samples: DataFrame) -> DataFrame:
    """`ts` parsed, plus date, year, month, day and hour."""
    return with_parsed_ts(samples).withColumns(calendar_parts(F.col("ts")))


def with_bucket(samples: DataFrame, grain: Grain) -> DataFrame:
    """`ts` parsed, plus `date` and the one bucket column the grain groups by."""
    parts = calendar_parts(F.col("ts"))
    return with_parsed_ts(samples).withColumns({key: parts[key] for key in grain.bucket_keys})


def partition_timestamp(grain: Grain) -> Column:
    """Start of a partition as a zone-less timestamp; absent parts are day 1 and hour 0."""
    defaults = {"day": 1, "hour": 0}
    year, month, day, hour = (
        F.col(part) if part in grain.partitions else F.lit(defaults[part])
        for part in ("year", "month", "day", "hour")
    )
    return F.make_timestamp_ntz(year, month, day, hour, F.lit(0), F.lit(0))


def year_month(year: Column, month: Column) -> Column:
    """Year and month joined without padding: January 2024 is `20241`."""
    return F.concat(year.cast("string"), month.cast("string"))
