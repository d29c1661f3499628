"""Fact tables of the ride and the sales mart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelhouse.functions import dates, geo, weather
from wheelhouse.functions.hashing import money, plain_hash
from wheelhouse.operators.joins import UNKNOWN_KEY, lookup, sized, unmatched, valid_at
from wheelhouse.operators.mutate import incoming, merge

# Fixed values.
NO_POSTAL_CODE = "0000"
NO_VEHICLE = 0


def ride_measures(
    rides: DataFrame, places: DataFrame, subscriptions: DataFrame | None = None, axis: str = "latlon"
) -> DataFrame:
    """Clean rides with duration, distance and the natural keys for the lookups.

    Rides that end before they start, or whose end is unknown, are left out.  The distance uses the
    ride's own points, else the stations of its locks (``places``), else 0.  Without ``subscriptions`` the
    rides carry their ``user_id``.  ``axis="lonlat"`` swaps the axes of every point.
    """
    valid = rides.where(F.col("start_time") <= F.col("end_time"))
    for side in ("start", "end"):
        take = {f"{side}_station_lat": "lat", f"{side}_station_lon": "lon", f"{side}_zipcode": "zipcode"}
        valid = lookup(valid, places, on={f"{side}_lock_id": "lock_id"}, take=take)
    if subscriptions is not None:
        valid = lookup(valid, subscriptions, on={"subscription_id": "subscription_id"}, take={"user_id": "user_id"})
    start, end = F.col("start_time"), F.col("end_time")
    return valid.select(
        "ride_id",
        "user_id",
        "start_lock_id",
        "end_lock_id",
        "start_time",
        "end_time",
        dates.elapsed_minutes(start, end).alias("ride_duration"),
        _distance(axis).alias("ride_distance"),
        F.to_date(start).alias("ride_date"),
        dates.hour_of(start).alias("start_hour"),
        F.coalesce(F.col("start_zipcode"), F.lit(NO_POSTAL_CODE)).alias("start_postal_code"),
        F.coalesce(F.col("vehicle_id"), F.lit(NO_VEHICLE)).alias("vehicle_id"),
    )


def _distance(axis: str) -> Column:
    names = ("lat", "lon") if axis == "latlon" else ("lon", "lat")

    def leg(start: str, end: str) -> tuple[Column, ...]:
        return tuple(F.col(f"{place}_{name}") for place in (start, end) for name in names)

    return geo.first_known_distance_km(leg("start", "end"), leg("start_station", "end_station"))


@dataclass(frozen=True)
class RideDimensions:
    """The dimensions of the ride fact, opened once for all increments of a run.

    The date and weather members are bounded by the calendar and by four rows; ``places`` comes from
    :func:`wheelhouse.plans.dimensions.lock_places`.
    """

    date: DataFrame
    weather: DataFrame
    user: DataFrame
    lock: DataFrame
    places: DataFrame
    hourly_weather: DataFrame

    def counted(self) -> RideDimensions:
        """The same, with the ones marked for broadcast that are counted to be small."""
        user, lock, places, hourly = sized(self.user, self.lock, self.places, self.hourly_weather)
        return RideDimensions(self.date, self.weather, user, lock, places, hourly)


def ride_facts(measures: DataFrame, dimensions: RideDimensions, user_lookup: str = "current") -> DataFrame:
    """The ride fact with its surrogate keys; a key that is not found becomes -1.

    ``user_lookup`` is ``"current"`` (the current version of the user) or ``"asof"`` (the version valid
    when the ride started).
    """
    facts = lookup(
        measures, dimensions.date, on={"ride_date": "date"}, take={"date_sk": "date_sk"}, default=UNKNOWN_KEY, small=True
    )
    take = {"user_sk": "user_sk"}
    if user_lookup == "current":
        facts = lookup(facts, dimensions.user, on={"user_id": "user_id"}, take=take, only=F.col("is_current"))
    else:
        facts = valid_at(
            facts, dimensions.user, "user_id", "user_id", "start_time", "start_date", "end_date", take
        )
    for side in ("start", "end"):
        facts = lookup(
            facts, dimensions.lock, on={f"{side}_lock_id": "lock_id"}, take={f"{side}_lock_sk": "lock_id"}, default=UNKNOWN_KEY
        )
    facts = lookup(
        facts,
        dimensions.hourly_weather,
        on={"start_postal_code": "zipcode", "start_hour": "weather_hour"},
        take={"weather_type": "weather_type"},
        default=weather.UNKNOWN,
    )
    facts = lookup(
        facts, dimensions.weather, on={"weather_type": "weather_type"}, take={"weather_id": "weather_id"}, default=UNKNOWN_KEY, small=True
    )
    return facts.select(
        "ride_id",
        "date_sk",
        F.coalesce(F.col("user_sk").cast("string"), F.lit(str(UNKNOWN_KEY))).alias("user_sk"),
        F.col("start_lock_sk").alias("start_lock_id"),
        F.col("end_lock_sk").alias("end_lock_id"),
        "weather_id",
        "vehicle_id",
        "ride_distance",
        "ride_duration",
    )


def new_rides(rides: DataFrame, loaded_facts: DataFrame) -> DataFrame:
    """Rides that are not loaded yet, whatever their number.

    A ride that comes late, or whose end was unknown when later ones were loaded, is found by a later run;
    a mark at the greatest loaded number would pass it by for ever.
    """
    return unmatched(rides, loaded_facts, ["ride_id"])


def sales_facts(sales: DataFrame, dim_date: DataFrame, dim_salesrep: DataFrame, max_versions: int = 1000) -> DataFrame:
    """The sales fact: date member and the version of the sales rep that was valid at the order date."""
    dated = lookup(
        sales.withColumn("order_day", F.to_date("order_date")),
        dim_date,
        on={"order_day": "calendar_date"},
        take={"date_sk": "date_sk"},
        small=True,
    )
    versioned = valid_at(
        dated,
        dim_salesrep,
        "salesrep_id",
        "salesrep_id",
        "order_date",
        "scd_start",
        "scd_end",
        {"salesrep_sk": "salesrep_sk"},
        max_versions=max_versions,
    )
    measures = [F.col("order_id"), F.col("date_sk"), F.col("salesrep_sk"), F.lit(1), money(F.col("amount"))]
    return versioned.select(
        "order_id",
        "date_sk",
        "salesrep_sk",
        F.lit(1).alias("count_mv"),
        F.col("amount").alias("revenue_mv"),
        plain_hash(*measures).alias("md5"),
    )


def merge_sales_facts(loaded: DataFrame, increment: DataFrame) -> DataFrame:
    """Bring an increment in: replace facts whose hash differs, add the ones not yet there."""
    return merge(loaded, increment, ["order_id"], update="all", when=incoming("md5") != F.col("md5"))


def with_year(facts: DataFrame, dim_date: DataFrame, keep_undated: bool = True) -> DataFrame:
    """Facts with the year and month of their date, for the partitioned export.

    Facts without a date member go to the NULL year, or away if ``keep_undated`` is off.
    """
    dated = lookup(facts, dim_date, on={"date_sk": "date_sk"}, take={"year": "year", "month": "month_nr"}, small=True)
    return dated if keep_undated else dated.where(F.col("year").isNotNull())


def as_stored(facts: DataFrame) -> DataFrame:
    """Ride facts as the fact table keeps them: the distance with two decimals, rounded from three."""
    return facts.withColumn("ride_distance", F.col("ride_distance").cast("decimal(18,3)").cast("decimal(10,2)"))
