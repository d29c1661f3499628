"""The named queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wheelhouse.operators.layout import spread
from wheelhouse.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(tune(spark), folder)
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table; a small one is shared out, as all of these queries work hard on each row."""
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))
