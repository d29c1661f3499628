"""Sales-mart queries and the practice queries on people and places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def revenue_by(facts: DataFrame, dimension: DataFrame, key: str, attribute: str, name: str) -> DataFrame:
    """Revenue per attribute of a dimension; facts without a member drop out.

    Facts are summed per surrogate key before the join, so a member with a large share of the facts
    is one row by then.
    """
    per_key = facts.groupBy(key).agg(F.sum("revenue_mv").alias("revenue"))
    joined = per_key.join(dimension.select(key, F.col(attribute).alias(name)), key)
    return joined.groupBy(name).agg(F.round(F.sum("revenue"), 2).alias("revenue"))


def revenue_by_weekday(facts: DataFrame, dim_date: DataFrame) -> DataFrame:
    return revenue_by(facts, dim_date, "date_sk", "day_of_week", "day_of_week")


def revenue_by_office(facts: DataFrame, dim_salesrep: DataFrame) -> DataFrame:
    return revenue_by(facts, dim_salesrep, "salesrep_sk", "office", "office")


def people_per_place(people: DataFrame, places: DataFrame, person: str, place_person: str, place: str) -> DataFrame:
    """Number of people per place, over a table that links the two."""
    linked = people.select(F.col(person).alias("person")).join(
        places.select(F.col(place_person).alias("person"), F.col(place)), "person"
    )
    return linked.groupBy(place).agg(F.count("person").alias("people"))
