"""Loads in batches that can be broken off anywhere and run again."""

from __future__ import annotations

import json
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wheelhouse.operators.partitioned import in_partitions, partitions_with
from wheelhouse.sinks.files import observed


class BatchTable:
    """A Parquet table that is loaded batch by batch, with a ledger of the batches that are part of it.

    A batch is staged in a folder of its own, below which there may be folders by the columns ``by``; it is verified, by
    counting what can be read back against what was written; then it is published, by a small file in the ledger that
    did not exist before.  Readers see the published batches alone, and all rows of one or none.  Nothing is renamed, so
    this holds on object stores as well.

    A run that ends before a batch is published leaves rows that nobody reads; the next run stages the batch anew in
    their place.  A run that ends afterwards finds the batch in the ledger and passes it by.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str] = ()) -> None:
        self.spark, self.path, self.schema, self.by = spark, path.rstrip("/"), schema, list(by)

    def _file(self, *names: str):
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        return path, path.getFileSystem(context._jsc.hadoopConfiguration())

    def published(self) -> dict[str, int]:
        """The published batches with their numbers of rows, from the ledger."""
        folder, files = self._file("ledger")
        if not files.exists(folder):
            return {}
        entries = self.spark.read.schema("batch string, rows long").json(f"{self.path}/ledger")
        return {row.batch: row.rows for row in entries.collect()}  # one small row for each batch

    def _folder(self, batch: str) -> str:
        return f"batches/{quote(batch, safe='')}"

    def load(self, batch: str, rows: DataFrame) -> int:
        """Bring a batch in unless it is there; the number of rows it holds."""
        done = self.published()
        if batch in done:
            return done[batch]
        written = self._stage(batch, rows)
        self._verify(batch, written)
        self._publish(batch, written)
        return written

    def _stage(self, batch: str, rows: DataFrame) -> int:
        seen = Observation()
        counted = rows.select(*self.schema.names).observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = (counted.hint("rebalance", *self.by) if self.by else counted).write.mode("overwrite")
        (writer.partitionBy(*self.by) if self.by else writer).parquet(f"{self.path}/{self._folder(batch)}")
        return observed(seen)["rows"]

    def _verify(self, batch: str, written: int) -> None:
        found = self._open([batch]).count()
        if found != written:
            raise ValueError(f"batch {batch}: {written} rows written, {found} found")

    def _publish(self, batch: str, written: int) -> None:
        """One file, which must not be there yet, in one write."""
        path, files = self._file("ledger", f"{quote(batch, safe='')}.json")
        out = files.create(path, False)
        out.write((json.dumps({"batch": batch, "rows": written}) + "\n").encode())
        out.close()

    def _open(self, batches: Sequence[str]) -> DataFrame:
        folders = [f"{self.path}/{self._folder(batch)}" for batch in batches]
        parts = [self.spark.read.schema(self.schema).parquet(folder) for folder in folders]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def read(self) -> DataFrame:
        return self._open(sorted(self.published()))

    def unloaded(self, source: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Source rows whose key is not loaded yet, however late they come.

        The columns ``by`` of the source tell which folders can hold them, and only those are looked at; a key must
        therefore always go with the same values of these columns.  As many values come to the driver as there are
        folders to look at.
        """
        near = self.read()
        if self.by:
            near = near.where(in_partitions(partitions_with(source, self.by), self.by))
        return source.join(near.select(*keys), list(keys), "left_anti")
