"""Distances, speeds and point columns."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_KM = 6371
KM_PER_DEGREE = 111.32
SLOWEST_METRES_PER_SECOND = 4.0
SPEED_STEPS = 300


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


_NUMBER = r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"
_POINT = rf"^\s*\(?\s*({_NUMBER})\s*,\s*({_NUMBER})\s*\)?\s*$"


def parse_point(text: Column) -> Column:
    """``'(x,y)'`` or ``'x,y'`` as a point; NULL for any other text."""
    return F.when(
        F.regexp_like(text, F.lit(_POINT)),
        point(F.regexp_extract(text, _POINT, 1), F.regexp_extract(text, _POINT, 2)),
    )


def degree_distance_km(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Straight line in degrees, scaled to kilometres."""
    return F.sqrt(F.pow(x1 - x2, F.lit(2)) + F.pow(y1 - y2, F.lit(2))) * F.lit(KM_PER_DEGREE)


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the spherical law of cosines.

    Rounding can push the cosine just past 1, so it is clamped; without that ``acos`` gives NaN.
    ``least``/``greatest`` skip NULL, hence the explicit test for missing coordinates.
    """
    cosine = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(
        F.radians(lon2) - F.radians(lon1)
    ) + F.sin(F.radians(lat1)) * F.sin(F.radians(lat2))
    clamped = F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0))
    missing = lat1.isNull() | lon1.isNull() | lat2.isNull() | lon2.isNull()
    return (
        F.when(missing, F.lit(None).cast("double"))
        .when((lat1 == lat2) & (lon1 == lon2), F.lit(0.0))
        .otherwise(F.acos(clamped) * F.lit(EARTH_RADIUS_KM))
    )


def first_known_distance_km(*legs: tuple[Column, Column, Column, Column]) -> Column:
    """The distance of the first leg whose four coordinates are known, else 0."""
    return F.coalesce(*(great_circle_km(*leg) for leg in legs), F.lit(0.0))


def speed_kmh(distance_km: Column, hours: Column) -> Column:
    return distance_km / F.nullif(hours, F.lit(0.0))


def assumed_speed(key: Column) -> Column:
    """A speed of 4.00 to 6.99 m/s that depends on the key alone, so that a re-run gives the same value."""
    return F.lit(SLOWEST_METRES_PER_SECOND) + F.pmod(key, F.lit(SPEED_STEPS)) / F.lit(100.0)


def register_great_circle(spark: SparkSession, name: str = "great_circle_km") -> None:
    """The same distance for ``spark.sql`` users, as a SQL function that the optimiser inlines."""
    cosine = (
        "cos(radians(lat1)) * cos(radians(lat2)) * cos(radians(lon2) - radians(lon1))"
        " + sin(radians(lat1)) * sin(radians(lat2))"
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE)
        RETURNS DOUBLE
        RETURN CASE WHEN lat1 IS NULL OR lon1 IS NULL OR lat2 IS NULL OR lon2 IS NULL THEN NULL
                    WHEN lat1 = lat2 AND lon1 = lon2 THEN 0D
                    ELSE acos(greatest(least({cosine}, 1D), -1D)) * {EARTH_RADIUS_KM} END"""
    )
