"""File writers.  Every write is one distributed job; nothing is paged through the driver."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wheelhouse.session import scratch_dir


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared scratch folder, for results that several later steps read."""
    path = scratch_dir(df.sparkSession, purpose)
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite", max_records_per_file: int = 0) -> None:
    """Partition folders with a sensible number of files.

    The rebalance hint gathers each folder's rows into few files, and adaptive execution splits a folder
    that holds too much for one task, so that one dominant year is still written in parallel.
    """
    writer = df.hint("rebalance", *(F.col(c) for c in by)).write.mode(mode).partitionBy(*by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    path: str | None = None,
    buckets: int = 0,
    bucket_by: Sequence[str] = (),
) -> None:
    """A catalog table; with ``path`` its files lie on shared storage.

    Tables that are joined again and again on the same key can be stored in the same number of buckets of
    that key; their joins then need no shuffle.
    """
    if buckets:
        df = df.repartition(buckets, *bucket_by)
    writer = df.write.mode(mode).format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_pairs_as_text(df: DataFrame, path: str, columns: Sequence[str], separator: str = ",") -> None:
    """One line of joined values per row."""
    line = F.concat_ws(separator, *(F.col(c).cast("string") for c in columns))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, keeping NULL properties visible."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def insert_statements(table: str, columns: Sequence[str], literals: Sequence[Column]) -> Column:
    """One ``INSERT`` statement per row from already rendered literals."""
    values = F.concat_ws(", ", *literals)
    return F.concat(F.lit(f"INSERT INTO {table} ({', '.join(columns)}) VALUES ("), values, F.lit(");"))


def observed(seen: Observation) -> dict[str, int]:
    """The counts of a finished write; zeros if Spark found its input to be empty and took the observation out."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "assertion failed" not in str(error.java_exception):
            raise
        return defaultdict(int)


def write_counted(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write and count in the same pass; the number of rows that went to the files."""
    seen = Observation()
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, mode)
    return observed(seen)["rows"]


def row_counts(spark: SparkSession, written: int, path: str) -> DataFrame:
    """Compare the number of rows that were written with what can be read back, as one row."""
    found = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("found"))
    expected = F.lit(written).cast("long")
    return found.select(expected.alias("expected"), "found", (F.col("found") == expected).alias("matches"))


def write_all(tables: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """Every table in a folder of its own, and the number of rows written to each."""
    return {name: write_counted(df, f"{folder}/{name}") for name, df in tables.items()}
