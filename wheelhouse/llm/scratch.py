"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wheelhouse.session import scratch_dir


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written below ``spark.checkpoint.dir`` and read again; cuts the lineage."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
