"""Relational sources and sinks over JDBC.

The database driver is put on the class path by the cluster; credentials come from the caller, who takes
them from the environment.  Range-split reads keep one connection from becoming the bottleneck.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession


@dataclass(frozen=True)
class RangeSplit:
    """Parallel read by ranges of a numeric, date or timestamp column."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


# SQLSTATE codes by which common databases report a missing table.
_NO_SUCH_TABLE = frozenset({"42704", "42P01", "42S02", "42S04", "42X05"})


def _sql_state(error: BaseException) -> str | None:
    """The SQLSTATE of the database's own exception behind an error, if there is one."""
    cause = getattr(error, "java_exception", None) or getattr(getattr(error, "_origin", None), "java_exception", None)
    while cause is not None:
        if hasattr(cause, "getSQLState") and "SQLException" in cause.getClass().getName():
            return cause.getSQLState()
        cause = cause.getCause()
    return getattr(error, "sql_state", None)


@dataclass(frozen=True)
class Database:
    url: str
    driver: str | None = None
    properties: dict[str, str] = field(default_factory=dict, repr=False)
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        base = {"url": self.url, "fetchsize": str(self.fetch_size), **self.properties}
        return {**base, "driver": self.driver} if self.driver else base

    def _reader(self, spark: SparkSession) -> DataFrameReader:
        return spark.read.format("jdbc").options(**self.options())

    def table(self, spark: SparkSession, name: str, split: RangeSplit | None = None) -> DataFrame:
        return self._load(spark, name, split)

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        """The result of a query that the database runs as a whole; read over one connection."""
        return self._reader(spark).option("query", sql).load()

    def subquery(self, spark: SparkSession, sql: str, split: RangeSplit | None = None) -> DataFrame:
        """A derived table: the source projects and filters, and the read can still be split by range."""
        return self._load(spark, derived_table(sql), split)

    def _load(self, spark: SparkSession, dbtable: str, split: RangeSplit | None) -> DataFrame:
        reader = self._reader(spark).option("dbtable", dbtable)
        return (reader.options(**split.options()) if split else reader).load()

    def has_table(self, spark: SparkSession, name: str) -> bool:
        """Probe a table by opening it; only its schema is fetched.  Any fault but a missing table is raised."""
        try:
            self.table(spark, name)
        except Exception as error:  # the JDBC driver decides the class of the error
            if _sql_state(error) not in _NO_SUCH_TABLE:
                raise
            return False
        return True

    def writer(self, df: DataFrame, name: str, mode: str) -> DataFrameWriter:
        """``append`` adds rows; ``overwrite`` empties the table but keeps its definition and keys."""
        writer = df.write.format("jdbc").options(**self.options()).option("dbtable", name).mode(mode)
        return writer.option("truncate", "true") if mode == "overwrite" else writer

    def write(self, df: DataFrame, name: str, mode: str = "append") -> None:
        self.writer(df, name, mode).save()


def derived_table(sql: str, alias: str = "subq") -> str:
    return f"({sql.strip().rstrip(';')}) {alias}"
