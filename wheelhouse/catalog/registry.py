"""Registration of named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wheelhouse.catalog.bindings import Tables
from wheelhouse.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables under ``name``, with SQL that gives the same rows."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(tune(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
