"""Weather categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dimension members and rule constants.
PLEASANT, UNPLEASANT, NEUTRAL, UNKNOWN = "Pleasant", "Unpleasant", "Neutral", "Unknown"
WEATHER_MEMBERS = [(1, PLEASANT), (2, UNPLEASANT), (3, NEUTRAL), (4, UNKNOWN)]
WET_CONDITIONS = ["Rain", "Snow", "Thunderstorm", "Drizzle"]
ZERO_CELSIUS_IN_KELVIN = 273.15
MILD_CELSIUS = 15.0
MILD_KELVIN = 288.15


def celsius(kelvin: Column) -> Column:
    return kelvin - F.lit(ZERO_CELSIUS_IN_KELVIN)


def weather_id(condition: Column, degrees_celsius: Column) -> Column:
    """Member id for the staging table: any wet condition, mild clear sky, anything else."""
    return (
        F.when(condition.isin(WET_CONDITIONS), F.lit(2))
        .when((condition == "Clear") & (degrees_celsius > MILD_CELSIUS), F.lit(1))
        .otherwise(F.lit(3))
    )


def weather_type(condition: Column, kelvin: Column) -> Column:
    """Member name for the ride fact: here rain alone is unpleasant."""
    return (
        F.when((condition == "Rain") | F.contains(condition, F.lit("rain")), F.lit(UNPLEASANT))
        .when((condition == "Clear") & (kelvin > MILD_KELVIN), F.lit(PLEASANT))
        .otherwise(F.lit(NEUTRAL))
    )
