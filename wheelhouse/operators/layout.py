"""How rows are spread over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _bytes(size: str) -> int:
    """A size setting of Spark in bytes."""
    number, unit = size.lower().rstrip("b"), 1
    for letter, factor in (("k", 10), ("m", 20), ("g", 30), ("t", 40)):
        if number.endswith(letter):
            number, unit = number[:-1], 1 << factor
    return int(number) * unit


def spread(df: DataFrame) -> DataFrame:
    """Share out a scan that gives fewer tasks than there are cores, before costly work on each row.

    A small file, or a few, would otherwise keep a few cores busy.  What is larger than a full scan task for every core
    is returned as it is, however few its files are, as Parquet is split by row groups; so at scale nothing is moved.
    Only the names and sizes of the files are looked at; nothing is run.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    full = cores * _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < full and len(df.inputFiles()) < cores else df
