"""Dimension builders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wheelhouse.functions import dates, weather
from wheelhouse.operators.keys import latest_per_key
from wheelhouse.operators.layout import spread
from wheelhouse.sources.files import WEATHER_SCHEMA, parse_json
from wheelhouse.sources.generated import date_sequence, inline_rows

# Default spans and the member that stands for "no lock".
RIDE_DATES = ("2015-01-01", "2024-12-31")
CALENDAR_DATES = ("2009-01-01", "2023-12-31")
NO_LOCK_ID, NO_LOCK_NUMBER = -1, "no lock"
LOCK_COLUMNS = ["lock_id", "station_id", "station_nr", "street", "number", "zipcode", "district", "gps_coord"]


def ride_dates(spark: SparkSession, first: str = RIDE_DATES[0], last: str = RIDE_DATES[1]) -> DataFrame:
    return ride_date_attributes(date_sequence(spark, first, last))


def ride_date_attributes(days: DataFrame) -> DataFrame:
    """Date dimension of the ride mart; ``date_sk`` counts the days from the first one, starting at 1."""
    day = F.col("date")
    return days.select(
        (F.datediff(day, F.col("origin")) + 1).alias("date_sk"),
        "date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month_nr"),
        dates.month_name(day).alias("month_name"),
        F.dayofmonth(day).alias("day_nr"),
        dates.day_name(day).alias("day_name"),
        dates.is_weekday(day).alias("is_weekday"),
    )


def calendar(spark: SparkSession, first: str = CALENDAR_DATES[0], last: str = CALENDAR_DATES[1]) -> DataFrame:
    return calendar_attributes(date_sequence(spark, first, last))


def calendar_attributes(days: DataFrame) -> DataFrame:
    """Date dimension of the sales mart; ``date_sk`` counts the days from the first one, starting at 0."""
    day = F.col("date")
    return days.select(
        F.datediff(day, F.col("origin")).alias("date_sk"),
        dates.date_int(day).alias("date_int"),
        day.alias("calendar_date"),
        F.year(day).alias("calendar_year"),
        dates.month_name(day).alias("calendar_month"),
        F.month(day).alias("month_of_year"),
        dates.day_name(day).alias("calendar_day"),
        F.dayofweek(day).alias("day_of_week"),
        dates.monday_first(day).alias("day_of_week_start_monday"),
        dates.yes_no(F.weekday(day) < 5).alias("is_week_day"),
        F.dayofmonth(day).alias("day_of_month"),
        dates.yes_no(dates.is_month_end(day)).alias("is_last_day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year_iso"),
        F.quarter(day).alias("quarter_of_year"),
    )


def weather_members(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, weather.WEATHER_MEMBERS, "weather_id int, weather_type string")


def weather_staging(documents: DataFrame, text: str = "value", zone: str = "UTC") -> DataFrame:
    """Weather documents as typed rows with their category."""
    doc = parse_json(F.col(text), WEATHER_SCHEMA)
    parsed = spread(documents.select(text)).select(doc.alias("doc")).select(
        F.col("doc.zipCode").alias("postal_code"),
        dates.from_epoch(F.col("doc.dt"), zone).alias("timestamp"),
        F.get(F.col("doc.weather"), F.lit(0))["main"].alias("weather_condition"),
        weather.celsius(F.col("doc.main.temp")).alias("temperature"),
    )
    return parsed.withColumn("weather_id", weather.weather_id(F.col("weather_condition"), F.col("temperature")))


def weather_hourly(documents: DataFrame, text: str = "value", dedupe: bool = True, zone: str = "UTC") -> DataFrame:
    """Weather type per postal code and hour, from the latest report of the hour.

    Reports with the same time are ordered by their temperature and condition.  ``dedupe=False`` keeps
    every report, which repeats a ride for each report of its hour.
    """
    doc = parse_json(F.col(text), WEATHER_SCHEMA)
    reports = spread(documents.select(text)).select(doc.alias("doc")).select(
        F.col("doc.zipCode").alias("zipcode"),
        F.col("doc.dt").alias("epoch"),
        F.get(F.col("doc.weather"), F.lit(0))["main"].alias("condition"),
        F.col("doc.main.temp").alias("kelvin"),
    ).withColumn("weather_hour", dates.hour_of(dates.from_epoch(F.col("epoch"), zone)))
    if dedupe:
        order = [F.col("epoch"), F.col("kelvin"), F.col("condition")]
        reports = latest_per_key(reports, ["zipcode", "weather_hour"], order)
    return reports.select(
        "zipcode", "weather_hour", weather.weather_type(F.col("condition"), F.col("kelvin")).alias("weather_type")
    )


def vehicles(vehicle: DataFrame, lots: DataFrame, types: DataFrame) -> DataFrame:
    """Vehicles with the description of their type, over their delivery lots."""
    typed = lots.join(types, "bike_type_id").select("lot_id", F.col("description").alias("type"))
    return vehicle.join(typed, "lot_id").select("vehicle_id", "type")


def locks(lock: DataFrame, stations: DataFrame) -> DataFrame:
    """Locks with their station, and the member for rides that ended outside a lock."""
    placed = lock.join(stations, "station_id").select(*LOCK_COLUMNS)
    member = {"lock_id": NO_LOCK_ID, "station_nr": NO_LOCK_NUMBER}
    row = tuple(member.get(name) for name in LOCK_COLUMNS)
    return placed.unionByName(inline_rows(lock.sparkSession, [row], placed.schema))


def lock_places(lock: DataFrame, stations: DataFrame) -> DataFrame:
    """Postal code and position of every lock."""
    return lock.join(stations, "station_id").select("lock_id", "station_id", "zipcode", "lat", "lon")
