"""Streams into a table by key, exactly once, with late rows kept."""

from __future__ import annotations

import datetime as dt
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wheelhouse.streaming import events as stream
from wheelhouse.streaming.upserts import WindowTable

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "at timestamp, key string, n int, extra string"


def batch(spark, *rows):
    return spark.createDataFrame([(None if s is None else BASE + dt.timedelta(seconds=s), k, n, "x") for s, k, n in rows], SCHEMA)


def shown(table):
    return sorted(((int((r.window_start - BASE).total_seconds()), str(r.key), r.total) for r in table.sums().collect()))


def late(table):
    return sorted(((r._batch, None if r.at is None else int((r.at - BASE).total_seconds()), r.n, None if r.closed_by is None else int((r.closed_by - BASE).total_seconds())) for r in table.late().collect()), key=str)


@pytest.fixture()
def table(spark, tmp_path):
    return WindowTable(spark, str(tmp_path / "t"), "at", ["key"], "n", "10 seconds", "10 seconds", every=2)


BATCHES = [
    [(1, "a", 1), (4, "a", 2), (12, "b", 5), (3, None, 9)],
    [(45, "a", 7), (2, "a", 1)],  # the mark is at 2: second 2 is in time
    [(3, "a", 100), (24, "b", 1), (38, "b", 2), (None, "c", 3)],  # the mark is at 35: windows up to 30 are closed
    [],
    [(90, "c", None), (36, "b", 4)],
    [(91, "c", 6), (44, "a", 8), (79, "d", 1)],  # the mark is at 80
]
SUMS = [(0, "None", 9), (0, "a", 4), (10, "b", 5), (30, "b", 6), (40, "a", 7), (90, "c", 6)]
LATE = [(2, 3, 100, 35), (2, 24, 1, 35), (2, None, 3, None), (5, 44, 8, 80), (5, 79, 1, 80)]


def test_sums_and_late_rows_are_all_rows(spark, table):
    for number, rows in enumerate(BATCHES):
        table.upsert(batch(spark, *rows), number)
    assert shown(table) == SUMS
    assert late(table) == sorted(LATE, key=str)
    whole = sum(n or 0 for rows in BATCHES for _, _, n in rows)
    assert sum(t for _, _, t in shown(table)) + sum(n for _, _, n, _ in late(table)) == whole


@pytest.mark.parametrize("again", [0, 1, 2, 5])
def test_a_batch_delivered_twice_changes_nothing(spark, table, again):
    for number, rows in enumerate(BATCHES):
        table.upsert(batch(spark, *rows), number)
        if number == again:
            table.upsert(batch(spark, *rows), number)
    assert shown(table) == SUMS and late(table) == sorted(LATE, key=str)


@pytest.mark.parametrize("kind", ["changes", "late", "state", "marks"])
def test_a_batch_broken_off_is_made_good(spark, table, kind, monkeypatch):
    """The fourth batch ends before it has written ``kind``; delivered again, nothing is lost or doubled."""
    real = WindowTable._write

    def dies(self, rows, what, number):
        if (what, number) == (kind, 3):
            raise KeyboardInterrupt
        real(self, rows, what, number)

    for number, rows in enumerate(BATCHES):
        if number == 3:
            monkeypatch.setattr(WindowTable, "_write", dies)
            with pytest.raises(KeyboardInterrupt):
                table.upsert(batch(spark, *rows), number)
            monkeypatch.undo()
        table.upsert(batch(spark, *rows), number)
    assert shown(table) == SUMS and late(table) == sorted(LATE, key=str)


def test_state_replaces_earlier_changes(spark, table):
    for number, rows in enumerate(BATCHES):
        table.upsert(batch(spark, *rows), number)
    assert table._batches("state") == [1, 3, 5]
    for number in range(4):
        shutil.rmtree(Path(table.path) / "changes" / f"batch={number}")
    assert shown(table) == SUMS


def test_the_stream_equals_spark_plus_the_late_rows(spark, tmp_path, table):
    """Spark's own windowed sums drop the late rows; ours are the same sums, and the late rows are there."""
    source, own = str(tmp_path / "in"), str(tmp_path / "own")
    batch(spark).write.parquet(source)

    def watched():
        return stream.file_stream(spark, source, batch(spark).schema)

    for rows in BATCHES[:3] + [[(300, "z", 1)], [(301, "z", 1)]]:
        batch(spark, *rows).coalesce(1).write.mode("append").parquet(source)
        table.follow(watched(), str(tmp_path / "c1")).awaitTermination()
        sums = stream.window_sums(watched().withWatermark("at", "10 seconds"), "at", "key", "n", "10 seconds")
        stream.append_to(sums, own, str(tmp_path / "c2")).awaitTermination()
    theirs = sorted((int((r.window.start - BASE).total_seconds()), str(r.key), r.total) for r in spark.read.parquet(own).collect())
    ours = [row for row in shown(table) if row[0] < 290]
    assert theirs == ours
    assert sorted(r.n for r in table.late().where(F.col("closed_by").isNotNull()).collect()) == [1, 100]
