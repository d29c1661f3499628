"""Event streams: read, parse, window, write.

The same transformations run on a batch DataFrame, which is how results are checked.  State is kept per
window and key, and dropped once the watermark has passed the window.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet", **options: str
) -> DataFrame:
    return spark.readStream.format(file_format).schema(schema).options(**options).load(path)


def kafka_options(servers: str, topics: str, starting_offsets: str = "latest") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topics, "startingOffsets": starting_offsets}


def kafka_stream(spark: SparkSession, servers: str, topics: str, starting_offsets: str = "latest") -> DataFrame:
    """A Kafka topic; needs Spark's Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topics, starting_offsets)).load()


def parse_events(stream: DataFrame, payload: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Typed columns ``{name: (json key, type)}`` from a binary or text JSON payload; a missing key is NULL."""
    keys = [key for key, _ in fields.values()]
    raw = [f"_{i}" for i in range(len(keys))]
    parsed = stream.select(F.json_tuple(F.col(payload).cast("string"), *keys).alias(*raw))
    return parsed.select(
        *(F.expr(f"try_cast({column} as {kind})").alias(name) for column, (name, (_, kind)) in zip(raw, fields.items()))
    )


def with_event_time(stream: DataFrame, column: str, delay: str) -> DataFrame:
    """Declare the event time and how late events may be.  Streams need a TIMESTAMP, not a zone-free one."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def window_sums(events: DataFrame, column: str, key: str, value: str, size: str, slide: str | None = None) -> DataFrame:
    """Sum per time window and key; windows overlap when ``slide`` is shorter than ``size``."""
    window = F.window(F.col(column), size, slide or size)
    return events.groupBy(window.alias("window"), F.col(key)).agg(F.sum(value).alias("total"))


def flat_window(sums: DataFrame) -> DataFrame:
    """The window as two zone-free timestamps."""
    bounds = [F.col(f"window.{b}").cast("timestamp_ntz").alias(f"window_{b}") for b in ("start", "end")]
    return sums.select(*bounds, *(c for c in sums.columns if c != "window"))


def append_to(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append finished rows to Parquet.  The checkpoint folder belongs to this query alone.

    With ``once`` the query works off what is there and stops by itself.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def update_each_batch(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Update mode: every micro-batch adds the rows it changed, with the number of the batch.

    The batch number partitions the target, and a batch that is run again replaces its own folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest_update(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The last state per key of a table written by :func:`update_each_batch`."""
    rest = [c for c in updates.columns if c not in (*keys, "batch")]
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch")).alias("_last"))
    return last.select(*keys, *(F.col(f"_last.{c}").alias(c) for c in rest))
