"""Structured Streaming queries: each works off the events table as a stream and reads back its sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wheelhouse.catalog.bindings import Tables
from wheelhouse.catalog.registry import query
from wheelhouse.session import scratch_dir
from wheelhouse.streaming import events as stream
from wheelhouse.streaming.upserts import WindowTable

DELAY = "10 seconds"
EVENT_FIELDS = {
    "event_id": ("event_id", "bigint"),
    "eventtime": ("timestamp", "timestamp"),
    "key": ("key", "string"),
    "value": ("value", "int"),
    "missing": ("word", "string"),
}


def event_stream(t: Tables) -> DataFrame:
    """The events table as a stream of Parquet files.

    A stream reads folders; written as a pattern the path may name a folder or a single file.
    """
    return stream.file_stream(t.spark, f"{t.folder}/{{events}}.parquet", t.events.schema)


def message_stream(t: Tables) -> DataFrame:
    """Events as JSON messages in a binary ``value`` column, as a message broker delivers them."""
    message = F.to_json(
        F.struct(
            F.col("event_id"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
            F.col("event_type").alias("key"),
            F.floor("value").cast("int").cast("string").alias("value"),
        )
    )
    return event_stream(t).select(message.cast("binary").alias("value"))


def parsed_stream(t: Tables) -> DataFrame:
    return stream.parse_events(message_stream(t), "value", EVENT_FIELDS)


def appended(t: Tables, rows: DataFrame, name: str) -> DataFrame:
    target = scratch_dir(t.spark, name)
    running = stream.append_to(rows, target, scratch_dir(t.spark, f"{name}-checkpoint"))
    running.awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(target)


PARSED_SQL = """SELECT event_id, ts AS eventtime, event_type AS key, CAST(floor(value) AS INT) AS value,
        CAST(NULL AS VARCHAR) AS missing FROM events"""


@query("stream_source", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_source(t: Tables) -> DataFrame:
    return appended(t, event_stream(t), "events")


def _zone_free(rows: DataFrame) -> DataFrame:
    return rows.withColumn("eventtime", F.col("eventtime").cast("timestamp_ntz"))


@query("stream_parse_json", PARSED_SQL)
def stream_parse_json(t: Tables) -> DataFrame:
    return _zone_free(appended(t, parsed_stream(t), "parsed"))


@query("stream_sink_append", PARSED_SQL)
def stream_sink_append(t: Tables) -> DataFrame:
    return _zone_free(appended(t, stream.with_event_time(parsed_stream(t), "eventtime", DELAY), "append"))


def _window_sql(size: int, slide: int, closed: bool) -> str:
    """Sums per window and key; ``closed`` keeps the windows that the watermark has passed."""
    watermark = "(SELECT max(ts) FROM events) - INTERVAL 10 SECOND"
    return f"""SELECT window_start, window_start + INTERVAL {size} SECOND AS window_end, key, CAST(sum(n) AS BIGINT) AS total
        FROM (SELECT time_bucket(INTERVAL {slide} SECOND, ts) - to_seconds({slide} * CAST(step AS INT)) AS window_start,
                     event_type AS key, CAST(floor(value) AS INT) AS n
              FROM events, range({size // slide}) steps(step))
        {f"WHERE window_start + INTERVAL {size} SECOND <= {watermark}" if closed else ""}
        GROUP BY window_start, key"""


def _summed(t: Tables, size: int, slide: int | None, name: str) -> DataFrame:
    timed = stream.with_event_time(parsed_stream(t), "eventtime", DELAY)
    sums = stream.window_sums(timed, "eventtime", "key", "value", f"{size} seconds", f"{slide or size} seconds")
    return stream.flat_window(appended(t, sums, name))


@query("stream_tumbling_sum", _window_sql(10, 10, closed=True))
def stream_tumbling_sum(t: Tables) -> DataFrame:
    return _summed(t, 10, None, "tumbling")


@query("stream_append_finalised", _window_sql(3600, 3600, closed=True))
def stream_append_finalised(t: Tables) -> DataFrame:
    """Hourly sums; the windows still open at the end of the stream are withheld."""
    return _summed(t, 3600, None, "hourly")


@query("stream_watermark", _window_sql(60, 30, closed=True))
def stream_watermark(t: Tables) -> DataFrame:
    """Overlapping windows of one minute every half minute, closed by the watermark."""
    return _summed(t, 60, 30, "sliding")


@query("tumbling_sum", _window_sql(10, 10, closed=False))
def tumbling_sum(t: Tables) -> DataFrame:
    """The batch twin of the windowed stream."""
    rows = t.events.select("ts", F.col("event_type").alias("key"), F.floor("value").cast("int").alias("value"))
    return stream.flat_window(stream.window_sums(rows, "ts", "key", "value", "10 seconds"))


def _updated(t: Tables, rows: DataFrame, name: str) -> DataFrame:
    target = scratch_dir(t.spark, name)
    running = stream.update_each_batch(rows, target, scratch_dir(t.spark, f"{name}-checkpoint"))
    running.awaitTermination()
    return t.spark.read.parquet(target)


@query("stream_update_passthrough", PARSED_SQL)
def stream_update_passthrough(t: Tables) -> DataFrame:
    timed = stream.with_event_time(parsed_stream(t), "eventtime", DELAY)
    return _zone_free(_updated(t, timed, "rows").drop("batch"))


@query("stream_sink_update", _window_sql(3600, 3600, closed=False))
def stream_sink_update(t: Tables) -> DataFrame:
    """Update mode shows every window at once, also those still open."""
    timed = stream.with_event_time(parsed_stream(t), "eventtime", DELAY)
    sums = stream.window_sums(timed, "eventtime", "key", "value", "3600 seconds")
    updates = _updated(t, stream.flat_window(sums), "updates")
    return stream.latest_update(updates, ["window_start", "window_end", "key"])


@query("stream_lifecycle", "SELECT event_type AS key, count(*) AS events FROM events GROUP BY event_type")
def stream_lifecycle(t: Tables) -> DataFrame:
    """A query that is stopped and started again on its checkpoint delivers every event once."""
    rows = parsed_stream(t).select("event_id", "key")
    target, checkpoint = scratch_dir(t.spark, "life"), scratch_dir(t.spark, "life-checkpoint")
    for _ in range(2):
        running = stream.append_to(rows, target, checkpoint)
        running.awaitTermination()
        running.stop()
    return t.spark.read.schema(rows.schema).parquet(target).groupBy("key").agg(F.count(F.lit(1)).alias("events"))


HOURLY_PARTS_SQL = """WITH parts AS (
        SELECT ts, event_type AS key, CAST(floor(value) AS INT) AS n, event_id,
               CASE WHEN event_id % 7 = 3 THEN 2 WHEN event_id % 2 = 0 THEN 0 ELSE 1 END AS part FROM events),
    marks AS (SELECT part, max(ts) AS latest FROM parts GROUP BY part),
    marked AS (
        SELECT p.*, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
               (SELECT max(latest) - INTERVAL 10 DAY FROM marks m WHERE m.part < p.part) AS closed_by FROM parts p)"""


def _arriving(t: Tables) -> WindowTable:
    """Events in three files, one micro-batch each: even numbers, odd ones, and every seventh, which comes last."""
    name = F.expr("CASE WHEN event_id % 7 = 3 THEN 2 WHEN event_id % 2 = 0 THEN 0 ELSE 1 END")
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("key"), F.floor("value").cast("int").alias("n"))
    source, table = scratch_dir(t.spark, "arrivals"), WindowTable(t.spark, scratch_dir(t.spark, "hourly"), "ts", ["key"], "n", "1 hour", "10 days", every=2)
    checkpoint = scratch_dir(t.spark, "hourly-checkpoint")
    for part in range(3):
        rows.where(name == part).write.mode("append").parquet(source)
        table.follow(stream.file_stream(t.spark, source, rows.schema), checkpoint).awaitTermination()
    return table


@query(
    "stream_upsert_sums",
    f"""{HOURLY_PARTS_SQL} SELECT window_start, window_end, key, CAST(sum(n) AS BIGINT) AS total FROM marked
        WHERE closed_by IS NULL OR window_end > closed_by GROUP BY window_start, window_end, key""",
)
def stream_upsert_sums(t: Tables) -> DataFrame:
    """Hourly sums that three micro-batches have brought in, without the rows that came too late."""
    sums = _arriving(t).sums().drop("_batch")
    return sums.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query(
    "stream_late_rows",
    f"{HOURLY_PARTS_SQL} SELECT event_id, ts, key, n, closed_by FROM marked WHERE window_end <= closed_by",
)
def stream_late_rows(t: Tables) -> DataFrame:
    """The rows that came after the watermark had closed their window, with that watermark."""
    late = _arriving(t).late().drop("_batch")
    return late.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ts", "closed_by")})
