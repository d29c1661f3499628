"""Date and time columns.  Batch timestamps are zone-free (TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SATURDAY, SUNDAY = 7, 1  # dayofweek() numbers
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


def is_weekday(day: Column) -> Column:
    return ~F.dayofweek(day).isin(SUNDAY, SATURDAY)


def yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def day_type(moment: Column) -> Column:
    """'Weekend' or 'Weekday'; an unknown moment counts as 'Weekday'."""
    return F.when(F.dayofweek(moment).isin(SUNDAY, SATURDAY), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def monday_first(day: Column) -> Column:
    return F.weekday(day) + F.lit(1)


def date_int(day: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def is_month_end(day: Column) -> Column:
    return F.to_date(day) == F.last_day(day)


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def _micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two moments as a double, negative when ``end`` comes first."""
    return (_micros(end) - _micros(start)) / F.lit(1_000_000.0)


def elapsed_minutes(start: Column, end: Column) -> Column:
    return elapsed_seconds(start, end) / F.lit(60.0)


def elapsed_hours(start: Column, end: Column) -> Column:
    return elapsed_seconds(start, end) / F.lit(3600.0)


def hour_of(moment: Column) -> Column:
    """The hour bucket of a zone-free timestamp."""
    return F.date_trunc("hour", moment).cast("timestamp_ntz")


def from_epoch(seconds: Column, zone: str = "UTC") -> Column:
    """Epoch seconds as a zone-free timestamp on the clock of ``zone``."""
    utc = F.timestamp_seconds(seconds)
    return (utc if zone == "UTC" else F.from_utc_timestamp(utc, zone)).cast("timestamp_ntz")


def format_timestamp(moment: Column) -> Column:
    return F.date_format(moment, TIMESTAMP_PATTERN)


def shift_years(moment: Column, years: int) -> Column:
    """The same day and time ``years`` later; keeps the time of day, unlike ``add_months``."""
    return moment + F.make_ym_interval(F.lit(years), F.lit(0))
