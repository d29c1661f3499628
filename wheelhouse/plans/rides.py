"""Ride analytics.

Rides are summed up per join key before they meet another table wherever the measure allows it: the
combine on the map side then leaves one row per key and task, so a subscription or vehicle with a
large share of all rides does not weigh on the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelhouse.functions import dates, geo

HOURLY_RATE = 10  # fixed value


def _start() -> Column:
    return F.col("start_time")


def _end() -> Column:
    return F.col("end_time")


def _lasts() -> Column:
    """The ride has an end after its start."""
    return _end() > _start()


def rides_by_city(rides: DataFrame, subscriptions: DataFrame, users: DataFrame) -> DataFrame:
    """Rides per city and postal code, not counting rides before the subscription was valid."""
    valid = rides.join(subscriptions, "subscription_id").where(_start() >= F.col("valid_from"))
    per_user = valid.groupBy("user_id").agg(F.count(F.lit(1)).alias("rides"))
    placed = per_user.join(users.select("user_id", "city", "zipcode"), "user_id")
    return placed.groupBy("city", "zipcode").agg(F.sum("rides").alias("ride_count")).orderBy(
        F.desc("ride_count"), "city", "zipcode"
    )


def average_user_duration(rides: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Mean over users of each user's mean ride minutes."""
    minutes = dates.elapsed_minutes(_start(), _end())
    per_subscription = rides.where(_end() >= _start()).groupBy("subscription_id").agg(
        F.sum(minutes).alias("minutes"), F.count(F.lit(1)).alias("rides")
    )
    per_user = (
        per_subscription.join(subscriptions.select("subscription_id", "user_id"), "subscription_id")
        .groupBy("user_id")
        .agg((F.sum("minutes") / F.sum("rides")).alias("user_avg"))
    )
    return per_user.agg(F.round(F.avg("user_avg"), 4).alias("overall_avg_ride_duration_minutes"))


def rides_by_day_type(rides: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Subscribed rides on weekdays and on weekends."""
    weekend = dates.day_type(_start()) == "Weekend"
    per_subscription = rides.groupBy("subscription_id").agg(
        F.count_if(weekend).alias("weekend"), F.count_if(~weekend).alias("weekday")
    )
    totals = per_subscription.join(subscriptions.select("subscription_id"), "subscription_id").agg(
        F.sum("weekend").alias("weekend"), F.sum("weekday").alias("weekday")
    )
    pairs = F.array(
        F.struct(F.lit("Weekend").alias("day_type"), F.col("weekend").alias("ride_count")),
        F.struct(F.lit("Weekday").alias("day_type"), F.col("weekday").alias("ride_count")),
    )
    return totals.select(F.inline(pairs)).where(F.col("ride_count") > 0)


def duration_by_day_name(rides: DataFrame) -> DataFrame:
    """Mean minutes of subscribed rides per day of the week."""
    subscribed = rides.where(_lasts() & F.col("subscription_id").isNotNull())
    minutes = dates.elapsed_minutes(_start(), _end())
    averages = subscribed.groupBy(dates.day_name(_start()).alias("day_of_week")).agg(
        F.round(F.avg(minutes), 4).alias("avg_ride_duration_minutes")
    )
    return averages.orderBy(F.desc("avg_ride_duration_minutes"), "day_of_week")


def station_popularity(rides: DataFrame, locks: DataFrame, stations: DataFrame) -> DataFrame:
    """How often the locks of each station were used, at the start or at the end of a ride.

    Both ends come out of one scan and are counted per lock before the lock table is joined.
    """
    used = rides.select(F.explode(F.array("start_lock_id", "end_lock_id")).alias("lock_id"))
    per_lock = used.where(F.col("lock_id").isNotNull()).groupBy("lock_id").agg(F.count(F.lit(1)).alias("uses"))
    per_station = per_lock.join(locks.select("lock_id", "station_id"), "lock_id").groupBy("station_id").agg(
        F.sum("uses").alias("uses")
    )
    ranked = stations.select("station_id", "station_nr", "street").join(per_station, "station_id", "left")
    return ranked.select(
        "station_id", "station_nr", "street", F.coalesce("uses", F.lit(0)).alias("usage_count")
    ).orderBy(F.desc("usage_count"), "station_id")


def _type_of(vehicles: DataFrame, lots: DataFrame, types: DataFrame) -> DataFrame:
    typed = lots.join(types, "bike_type_id").select("lot_id", "description")
    return vehicles.select("vehicle_id", "lot_id").join(typed, "lot_id").select("vehicle_id", "description")


def rides_by_bike_type(rides: DataFrame, vehicles: DataFrame, lots: DataFrame, types: DataFrame) -> DataFrame:
    """Subscribed rides with a positive duration per bike type."""
    valid = rides.where(F.col("subscription_id").isNotNull() & _lasts())
    per_vehicle = valid.groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("rides"))
    typed = per_vehicle.join(_type_of(vehicles, lots, types), "vehicle_id")
    return typed.groupBy("description").agg(F.sum("rides").alias("ride_count")).orderBy(
        F.desc("ride_count"), "description"
    )


def retention_rate(rides: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Share of riding users with more than one ride, in percent."""
    per_subscription = rides.where(F.col("subscription_id").isNotNull()).groupBy("subscription_id").agg(
        F.count(F.lit(1)).alias("rides")
    )
    per_user = (
        per_subscription.join(subscriptions.select("subscription_id", "user_id"), "subscription_id")
        .groupBy("user_id")
        .agg(F.sum("rides").alias("total_rides"))
    )
    returning = F.count_if(F.col("total_rides") > 1) * F.lit(100.0) / F.nullif(F.count(F.lit(1)), F.lit(0))
    return per_user.agg(F.round(returning, 4).alias("retention_rate_percentage"))


def _mean_by_bike_type(
    rides: DataFrame,
    vehicles: DataFrame,
    lots: DataFrame,
    types: DataFrame,
    subscriptions: DataFrame,
    measure: Column,
    name: str,
) -> DataFrame:
    """Mean of a ride measure per bike type over subscribed rides; a NULL measure does not count."""
    valid = rides.where(_lasts()).join(subscriptions.select("subscription_id"), "subscription_id", "left_semi")
    per_vehicle = valid.groupBy("vehicle_id").agg(F.sum(measure).alias("total"), F.count(measure).alias("counted"))
    typed = per_vehicle.join(_type_of(vehicles, lots, types), "vehicle_id")
    mean = F.sum("total") / F.nullif(F.sum("counted"), F.lit(0))
    return typed.groupBy("description").agg(F.round(mean, 4).alias(name)).orderBy(F.desc(name), "description")


def _straight_km() -> Column:
    return geo.degree_distance_km(F.col("start_lat"), F.col("start_lon"), F.col("end_lat"), F.col("end_lon"))


def speed_by_bike_type(
    rides: DataFrame, vehicles: DataFrame, lots: DataFrame, types: DataFrame, subscriptions: DataFrame
) -> DataFrame:
    speed = geo.speed_kmh(_straight_km(), dates.elapsed_hours(_start(), _end()))
    return _mean_by_bike_type(rides, vehicles, lots, types, subscriptions, speed, "avg_speed_kmh")


def distance_by_bike_type(
    rides: DataFrame, vehicles: DataFrame, lots: DataFrame, types: DataFrame, subscriptions: DataFrame
) -> DataFrame:
    return _mean_by_bike_type(rides, vehicles, lots, types, subscriptions, _straight_km(), "avg_distance_km")


def revenue_by_subscription_type(
    rides: DataFrame, subscriptions: DataFrame, types: DataFrame, as_of: str, only_forward: bool = False
) -> DataFrame:
    """Estimated revenue per subscription type at a fixed rate per hour.

    ``num_subscriptions`` counts rides, since every ride repeats its subscription.  Rides that end before
    they start count with a negative duration unless ``only_forward`` is set.
    """
    counted = rides.where(_end() >= _start()) if only_forward else rides
    hours = dates.elapsed_hours(_start(), _end())
    per_subscription = counted.groupBy("subscription_id").agg(
        F.count(F.lit(1)).alias("rides"), F.sum(hours).alias("hours")
    )
    valid = subscriptions.where(F.col("valid_from") <= F.lit(as_of).cast("timestamp_ntz"))
    per_type = (
        per_subscription.join(valid.select("subscription_id", "subscription_type_id"), "subscription_id")
        .groupBy("subscription_type_id")
        .agg(F.sum("rides").alias("rides"), F.sum("hours").alias("hours"))
    )
    described = per_type.join(types, "subscription_type_id").groupBy(F.col("description").alias("subscription_type"))
    revenue = described.agg(
        F.sum("rides").alias("num_subscriptions"),
        F.round(F.sum("hours") * HOURLY_RATE, 4).alias("estimated_revenue"),
    )
    return revenue.orderBy(F.desc("estimated_revenue"), "subscription_type")


def rides_per_user_by_year(rides: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Rides, riding users and whole rides per user for every year.

    Counting per year and user first makes the distinct count a plain count of groups.
    """
    counted = (
        rides.where(_lasts())
        .groupBy("subscription_id", F.year("start_time").alias("ride_year"))
        .agg(F.count(F.lit(1)).alias("rides"))
    )
    per_user = (
        counted.join(subscriptions.select("subscription_id", "user_id"), "subscription_id")
        .groupBy("ride_year", "user_id")
        .agg(F.sum("rides").alias("rides"))
    )
    total, users = F.sum("rides"), F.count("user_id")
    return (
        per_user.groupBy("ride_year")
        .agg(total.alias("total_rides"), users.alias("total_users"))
        .withColumn("avg_rides_per_user", F.expr("total_rides div nullif(total_users, 0)"))
        .orderBy(F.desc("ride_year"))
    )
