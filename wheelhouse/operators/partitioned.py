"""UPDATE, DELETE and MERGE on stored tables with partition folders, which touch only the folders that change."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wheelhouse.operators import mutate
from wheelhouse.sinks.files import staged


def in_partitions(values: Sequence[Mapping[str, object]], by: Sequence[str]) -> Column:
    """Whether a row is in one of the partitions; only partition columns are looked at, so it prunes the scan.

    By one column it is a list of values, by several a list for each combination of the columns before the last.
    """
    if not values:
        return F.lit(False)
    *outer, last = by
    groups: dict[tuple, list[object]] = {}
    for value in values:
        groups.setdefault(tuple(value[c] for c in outer), []).append(value[last])
    terms = []
    for key, members in groups.items():
        known = [m for m in members if m is not None]
        term = F.col(last).isin(known) if known else F.lit(False)
        term = term | F.col(last).isNull() if None in members else term
        for c, v in zip(outer, key):
            term = term & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
        terms.append(term)
    return reduce(lambda a, b: a | b, terms)


def partitions_with(df: DataFrame, by: Sequence[str], condition: Column | None = None) -> list[dict[str, object]]:
    """The partitions that hold a row for which ``condition`` is true; as many rows come back as there are partitions."""
    hit = df if condition is None else df.where(condition)
    return [row.asDict() for row in hit.select(*by).distinct().collect()]


class PartitionedTable:
    """A Parquet table on shared storage with a folder for each value of the columns ``by``.

    A change first finds the partitions with rows to be changed, by reading the columns of its condition alone; then it
    reads those partitions, writes their new rows to the scratch folder, and puts these in place of the old files in one
    commit (dynamic partition overwrite).  Files of all other partitions are neither read as a whole nor written.
    Partitions that rows move to are written anew with the rows they hold.  A partition left without rows goes after
    that commit; a run that ends between the two leaves its old rows, and the same change can be run again.

    One writer at a time, as for any table of plain files.  Every method returns the partitions it wrote.
    """

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str], schema: T.StructType | None = None) -> None:
        """Without ``schema``, the types of the columns ``by`` are told from the folders' names."""
        self.spark, self.path, self.by, self.schema = spark, path.rstrip("/"), list(by), schema

    def read(self) -> DataFrame:
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.parquet(self.path)

    def write(self, df: DataFrame) -> None:
        """The whole table anew."""
        self._writer(df, "static").parquet(self.path)

    def update_where(self, condition: Column, values: Mapping[str, Column]) -> list[dict[str, object]]:
        return self._change(condition, lambda rows: mutate.update_where(rows, condition, values))

    def delete_where(self, condition: Column) -> list[dict[str, object]]:
        return self._change(condition, lambda rows: mutate.delete_where(rows, condition))

    def merge(self, source: DataFrame, keys: Sequence[str], **clauses) -> list[dict[str, object]]:
        """:func:`wheelhouse.operators.mutate.merge` into the table.

        Only the keys of the whole table are read, to find the partitions with a row that the source matches.  Source
        rows that match none of them match nothing at all, so merging into those partitions gives the whole result.
        """
        table = self.read()
        wanted = source.select(*(F.col(k).alias(f"__w_{k}") for k in keys)).distinct()
        matched = table.join(wanted, [F.col(k) == F.col(f"__w_{k}") for k in keys], "left_semi")
        touched = partitions_with(matched, self.by)
        return self._replace(touched, mutate.merge(table.where(in_partitions(touched, self.by)), source, keys, **clauses))

    def _change(self, condition: Column, change: Callable[[DataFrame], DataFrame]) -> list[dict[str, object]]:
        table = self.read()
        touched = partitions_with(table, self.by, condition)
        return self._replace(touched, change(table.where(in_partitions(touched, self.by)))) if touched else []

    def _replace(self, touched: list[dict[str, object]], rows: DataFrame) -> list[dict[str, object]]:
        """Put ``rows`` in place of the touched partitions."""
        new = staged(rows, "changed-partitions")
        now = partitions_with(new, self.by)
        reached = [p for p in now if p not in touched]
        if reached:
            new = staged(new.unionByName(self.read().where(in_partitions(reached, self.by))), "changed-partitions")
        if now:
            self._writer(new, "dynamic").parquet(self.path)
        for partition in touched:
            if partition not in now:
                self._drop(partition)
        return [*touched, *reached]

    def _writer(self, df: DataFrame, overwrite: str):
        spread = df.hint("rebalance", *(F.col(c) for c in self.by))
        return spread.write.mode("overwrite").option("partitionOverwriteMode", overwrite).partitionBy(*self.by)

    def _drop(self, partition: Mapping[str, object]) -> None:
        """Remove the folder of a partition; its name is that of its files."""
        file = F.col("_metadata.file_path")
        folders = self.read().where(in_partitions([partition], self.by)).select(F.regexp_extract(file, "^(.*)/", 1).alias("folder")).distinct()
        context = self.spark.sparkContext
        for row in folders.collect():
            path = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(row.folder))
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
