"""Distance between two points and the four classes of harsh driving."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripgrain.schema import EVENT_COUNTS

EARTH_RADIUS_M = 6_371_000.0
STOP_SPEED = 5.0
HARSH_CHANGE = 10.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres between two points; 0 where a coordinate is NULL.

    The NULL guard is needed: `least` skips NULLs, so clamping alone would turn "no previous
    point" into half the way around the globe.
    """
    across = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    chord = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2.0) + across * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), 2.0
    )
    metres = 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))
    unknown = lat1.isNull() | lon1.isNull() | lat2.isNull() | lon2.isNull()
    return F.when(unknown, 0.0).otherwise(metres)


def finite(value: Column) -> Column:
    """True for an ordinary number; not for NaN, which sorts above infinity."""
    return F.abs(value) < F.lit(float("inf"))


def motion_inputs() -> dict[str, Column]:
    """Coordinates that are known or unknown as a pair, and speed in two decimals.

    What is not a finite number is unknown.
    """
    latitude, longitude, sp = (
        F.col(name).cast("double") for name in ("latitude", "longitude", "sp")
    )
    located = finite(latitude) & finite(longitude)
    return {
        "latitude": F.when(located, latitude),
        "longitude": F.when(located, longitude),
        "sp": F.when(finite(sp), F.round(sp, 2)),
    }


def speed_change(ct1: Column, sp1: Column, ct2: Column, sp2: Column) -> Column:
    """Change of speed per unit of `ct`; NULL without progress in `ct`."""
    return F.when(ct2 > ct1, F.try_divide(sp2 - sp1, (ct2 - ct1).cast("double")))


def harsh_events(
    sp1: Column,
    sp2: Column,
    change: Column,
    stop_speed: float = STOP_SPEED,
    harsh: float = HARSH_CHANGE,
) -> dict[str, Column]:
    """0/1 flags for the step from speed `sp1` to `sp2`; the four classes are disjoint.

    A step with an unknown speed or change raises no flag.
    """
    rises, drops = change >= harsh, change <= -harsh
    classes = [
        rises & (sp1 <= stop_speed),
        drops & (sp2 <= stop_speed),
        rises & (sp1 > stop_speed),
        drops & (sp2 > stop_speed),
    ]
    return {
        name: F.when(happens, 1).otherwise(0) for name, happens in zip(EVENT_COUNTS, classes)
    }
