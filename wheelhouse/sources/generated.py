"""Rows that come from arguments or from the span of another table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def date_sequence(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last``; ``origin`` repeats the first day."""
    ends = spark.range(0, 1, 1, 1).select(F.lit(first).cast("date").alias("origin"), F.lit(last).cast("date").alias("until"))
    return _days_between(ends)


def dates_covering(df: DataFrame, column: str) -> DataFrame:
    """One row per day of all the calendar years that ``column`` touches."""
    span = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return _days_between(
        span.select(
            F.trunc("lo", "year").alias("origin"),
            F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1).alias("until"),
        )
    )


MOST_DAYS = 366 * 300  # of a calendar, which is broadcast to the facts


def _days_between(ends: DataFrame) -> DataFrame:
    """All days of a span; a longer one than :data:`MOST_DAYS` is an error, as one wild date would make it."""
    wild = F.raise_error(F.concat(F.lit("calendar: too many days up to "), F.col("until").cast("string"))).cast("date")
    until = F.when(F.datediff("until", "origin") > MOST_DAYS, wild).otherwise(F.col("until").cast("date"))
    days = F.sequence(F.col("origin").cast("date"), until, F.expr("interval 1 day"))
    return ends.select("origin", F.explode(days).alias("date"))


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A handful of fixed members with an explicit schema.

    The rows are literals of the plan: Spark then knows that they are few and broadcasts what they join.
    """
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    members = [
        F.struct(*(F.lit(value).cast(f.dataType).alias(f.name) for f, value in zip(fields, row))) for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*members)))
