"""Streams against their batch form, over several micro-batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wheelhouse.streaming import events as stream

FIELDS = {"eventtime": ("timestamp", "timestamp"), "key": ("key", "string"), "value": ("value", "int")}


def put(spark, folder, name, messages):
    """One file of JSON messages, written beside the watched folder's earlier files."""
    df = spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1)
    df.write.mode("append").text(str(folder))


def message(second, key, value):
    stamp = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)
    return f'{{"timestamp": "{stamp}", "key": "{key}", "value": {value}}}'


def timed(spark, folder):
    raw = stream.file_stream(spark, str(folder), spark.range(0).select(F.lit("").alias("value")).schema, "text")
    return stream.with_event_time(stream.parse_events(raw, "value", FIELDS), "eventtime", "10 seconds")


def run(query):
    query.awaitTermination()


def second(moment):
    return int((moment - dt.datetime(2024, 1, 1)).total_seconds())


@pytest.fixture()
def folders(tmp_path):
    return tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")


def test_late_rows_are_dropped_and_open_windows_withheld(spark, folders):
    source, out, checkpoint = folders
    put(spark, source, "a", [message(1, "a", 1), message(4, "a", 2), message(12, "b", 5)])

    def sums():
        return stream.flat_window(stream.window_sums(timed(spark, source), "eventtime", "key", "value", "10 seconds"))

    def found():
        got = spark.read.parquet(out).collect()
        return sorted((second(r.window_start), r.key, r.total) for r in got)

    run(stream.append_to(sums(), out, checkpoint))
    put(spark, source, "b", [message(45, "a", 7)])
    run(stream.append_to(sums(), out, checkpoint))
    assert found() == [(0, "a", 3), (10, "b", 5)]
    put(spark, source, "c", [message(2, "a", 100), message(90, "c", 1)])  # second 2 is long closed
    run(stream.append_to(sums(), out, checkpoint))
    assert found() == [(0, "a", 3), (10, "b", 5), (40, "a", 7)]


def test_overlapping_windows_equal_batch(spark):
    rows = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, s), "a", s) for s in (1, 7, 14)], "eventtime timestamp_ntz, key string, value int"
    )
    got = stream.flat_window(stream.window_sums(rows, "eventtime", "key", "value", "10 seconds", "5 seconds")).collect()
    assert sorted((second(r.window_start), r.total) for r in got) == [(-5, 1), (0, 8), (5, 21), (10, 14)]


def test_update_mode_shows_changed_windows(spark, folders):
    source, out, checkpoint = folders

    def sums():
        return stream.flat_window(stream.window_sums(timed(spark, source), "eventtime", "key", "value", "10 seconds"))

    put(spark, source, "a", [message(1, "a", 1), message(2, "b", 1)])
    run(stream.update_each_batch(sums(), out, checkpoint))
    put(spark, source, "b", [message(3, "a", 4)])
    run(stream.update_each_batch(sums(), out, checkpoint))
    updates = spark.read.parquet(out)
    latest = stream.latest_update(updates, ["window_start", "window_end", "key"])
    assert sorted((r.key, r.total) for r in latest.collect()) == [("a", 5), ("b", 1)]
    assert updates.where("key = 'b'").count() == 1


def test_restart_delivers_once(spark, folders):
    source, out, checkpoint = folders
    put(spark, source, "a", [message(1, "a", 1)])
    for _ in range(2):
        run(stream.append_to(timed(spark, source), out, checkpoint))
    put(spark, source, "b", [message(2, "a", 2)])
    run(stream.append_to(timed(spark, source), out, checkpoint))
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == [1, 2]


def test_bad_messages_become_nulls(spark, rows):
    df = spark.createDataFrame([(b'{"key": "k", "value": "x"}',), (b"no json",)], "value binary")
    assert rows(stream.parse_events(df, "value", FIELDS)) == [(None, None, None), (None, "k", None)]


def test_kafka_options():
    assert stream.kafka_options("host:9092", "demo") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "demo",
        "startingOffsets": "latest",
    }
