"""Table shapes: the position samples, the three grains and their gold tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

POSITION_COLUMNS = ["trip_id", "user_id", "vehicle_id", "ts", "latitude", "longitude", "ct", "sp"]

# What is computed with must have these types; ids are only grouped and counted, so any will do.
COMPUTED_TYPES = {
    "ts": (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType),
    "latitude": T.NumericType,
    "longitude": T.NumericType,
    "ct": T.IntegralType,
    "sp": T.NumericType,
}

# The order of samples inside a trip. `ct` is the recorded ordinal; the rest only breaks ties, so
# that an answer never depends on how the input happened to be laid out. Speed makes no difference
# to a path, which lets distances do without that column.
PATH_ORDER = ["ct", "ts", "latitude", "longitude"]
SAMPLE_ORDER = [*PATH_ORDER, "sp"]

EVENT_COUNTS = [
    "total_sudden_start_count",
    "total_sudden_stop_count",
    "total_acceleration_count",
    "total_deceleration_count",
]

TOTALS = ["trip_count", "user_count", "vehicle_count", "total_driving_time", "total_distance"]


def check_positions(positions: DataFrame) -> None:
    """Refuse a table that lacks sample columns or has them in a type that cannot be computed."""
    found = {field.name: field.dataType for field in positions.schema}
    problems = [f"{name} is missing" for name in POSITION_COLUMNS if name not in found]
    problems += [
        f"{name} is {found[name].simpleString()}"
        for name, kinds in COMPUTED_TYPES.items()
        if name in found and not isinstance(found[name], kinds)
    ]
    if problems:
        raise ValueError("not a table of position samples: " + ", ".join(problems))


@dataclass(frozen=True)
class Grain:
    """One reporting grain: its time bucket, its partition columns and its gold layout.

    A gold table has the `leading` columns, then the averages, then the `trailing` columns.
    """

    name: str
    partitions: tuple[str, ...]
    has_events: bool
    leading: tuple[str, ...]
    trailing: tuple[str, ...] = ()

    @property
    def bucket_keys(self) -> list[str]:
        return ["date", self.name]

    @property
    def trip_keys(self) -> list[str]:
        return ["date", self.name, "trip_id"]

    @property
    def trip_totals(self) -> list[str]:
        """Per-trip measures that are summed per bucket."""
        return TOTALS[1:] + (EVENT_COUNTS if self.has_events else [])

    @property
    def averaged(self) -> dict[str, str]:
        """Average column -> the total it divides by the trip count."""
        if not self.has_events:
            return {"avg_distance": "total_distance"}
        totals = ["total_distance", "total_driving_time"] + EVENT_COUNTS
        return {total.replace("total_", "avg_"): total for total in totals}

    @property
    def gold_columns(self) -> list[str]:
        return [*self.leading, *self.averaged, *self.trailing]


HOUR = Grain(
    "hour",
    ("year", "month", "day", "hour"),
    True,
    ("date", "hour", *TOTALS, *EVENT_COUNTS, "year", "month", "day"),
)
DAY = Grain(
    "day",
    ("year", "month", "day"),
    True,
    ("date", "day", *TOTALS, *EVENT_COUNTS, "year", "month"),
    ("year_month",),
)
MONTH = Grain(
    "month",
    ("year", "month"),
    False,
    ("year_month", "month", *TOTALS, "year"),
)

GRAINS = {grain.name: grain for grain in (HOUR, DAY, MONTH)}
