"""Streams into a table by key, each micro-batch exactly once, with late rows kept apart.

Every micro-batch leaves three small datasets under its number: the keys it changed with their new values, the rows that
came too late, and one row with the greatest event time.  Written again after a failure, it reads only what batches before
it have left and replaces its own, so a batch that is delivered twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH = "_batch"


class WindowTable:
    """Sums by time window and key, kept by a stream on shared storage.

    A row is late if its window had ended before the watermark of its batch: the greatest event time of all batches
    before, less ``delay``, as in Spark's own windowed sums, which drop such rows.  Here they go to :meth:`late` with the
    mark that closed their window, so the sums and the late rows together are all rows.  Rows without event time belong to
    no window and are late without a mark.

    Keys are kept as text, sums as whole numbers; a sum of nothing but NULLs is NULL.

    Every ``every`` batches the whole state is written along, so that a batch reads the latest of those and the changes
    after it, not all changes ever made.
    """

    def __init__(self, spark: SparkSession, path: str, time: str, keys: Sequence[str], value: str, size: str, delay: str, every: int = 10) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.time, self.keys, self.value, self.size, self.delay, self.every = time, list(keys), value, size, delay, every

    # --- what is there -----------------------------------------------------------------------------

    def _batches(self, kind: str, before: int | None = None) -> list[int]:
        """The batches that have written ``kind`` whole, in order."""
        context = self.spark.sparkContext
        pattern = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/batch=*/_SUCCESS")
        found = pattern.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(pattern) or []
        numbers = sorted(int(file.getPath().getParent().getName().split("=")[1]) for file in found)
        return [n for n in numbers if before is None or n < before]

    def _read(self, kind: str, batches: Sequence[int], schema: str) -> DataFrame:
        folders = [f"{self.path}/{kind}/batch={n}" for n in batches]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _sum_schema(self) -> str:
        kinds = "".join(f"`{key}` string, " for key in self.keys)
        return f"window_start timestamp, window_end timestamp, {kinds}total bigint, {BATCH} bigint"

    def mark(self, before: int | None = None) -> str | None:
        """The watermark that holds for a batch, from the batches before it."""
        seen = self._read("marks", self._batches("marks", before), "latest timestamp")
        mark = F.max("latest") - F.expr(f"INTERVAL {self.delay}")
        return seen.agg(mark.cast("string").alias("mark")).first().mark

    def sums(self, before: int | None = None) -> DataFrame:
        """The latest sum of every window and key."""
        whole = self._batches("state", before)
        start = whole[-1] if whole else -1
        parts = self._read("state", whole[-1:], self._sum_schema())
        rows = parts.unionByName(self._read("changes", [n for n in self._batches("changes", before) if n > start], self._sum_schema()))
        names = ["window_start", "window_end", *self.keys]
        last = rows.groupBy(*names).agg(F.max_by(F.struct("total", BATCH), BATCH).alias("_last"))
        return last.select(*names, "_last.total", f"_last.{BATCH}")

    def late(self) -> DataFrame:
        """All late rows, with the watermark that had closed their window and the number of their batch."""
        folders = [f"{self.path}/late/batch={n}" for n in self._batches("late")]
        if not folders:
            raise ValueError("no batch has been written yet")
        return self.spark.read.option("mergeSchema", "true").parquet(*folders)

    # --- one micro-batch ---------------------------------------------------------------------------

    def upsert(self, batch: DataFrame, number: int) -> None:
        """Bring a micro-batch in; its number says which one it is."""
        mark = self.mark(before=number)
        bound = F.lit(mark).cast("timestamp")
        window = F.window(F.col(self.time), self.size)
        known = batch.where(F.col(self.time).isNotNull()).withColumn("__window", window)
        in_time = F.lit(True) if mark is None else F.col("__window.end") > bound
        bounds = [F.col("__window.start").alias("window_start"), F.col("__window.end").alias("window_end")]
        keys = [F.col(key).cast("string").alias(key) for key in self.keys]
        added = known.where(in_time).groupBy(*bounds, *keys).agg(F.sum(self.value).cast("bigint").alias("added"))

        names = ["window_start", "window_end", *self.keys]
        old = self.sums(before=number).drop(BATCH).select(*(F.col(n).alias(f"__{n}") for n in names), "total")
        same = [F.col(n).eqNullSafe(F.col(f"__{n}")) for n in names]
        # A sum over nothing but NULLs is NULL, as in SQL, until a number comes.
        total = F.when(F.col("total").isNull(), F.col("added")).otherwise(F.col("total") + F.coalesce("added", F.lit(0)))
        changed = added.join(old, same, "left").select(*names, total.alias("total"), F.lit(number).cast("bigint").alias(BATCH))
        self._write(changed, "changes", number)

        closed = known.where(~in_time).drop("__window").unionByName(batch.where(F.col(self.time).isNull()))
        closing = F.when(F.col(self.time).isNotNull(), bound).alias("closed_by")
        self._write(closed.select("*", closing, F.lit(number).cast("bigint").alias(BATCH)), "late", number)
        if number % self.every == self.every - 1:
            self._write(self.sums(before=number + 1), "state", number)
        # Last, as the next batch's watermark comes from it.
        self._write(batch.agg(F.max(self.time).cast("timestamp").alias("latest")), "marks", number)

    def _write(self, rows: DataFrame, kind: str, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{kind}/batch={number}")

    def follow(self, stream: DataFrame, checkpoint: str, once: bool = True) -> StreamingQuery:
        """Run the stream into the table; with ``once`` it works off what is there and stops by itself."""
        writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.upsert)
        return (writer.trigger(availableNow=True) if once else writer).start()
