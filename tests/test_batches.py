"""Loads in batches that are broken off and run again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wheelhouse.sinks.batches import BatchTable

SCHEMA = "id long, v string, year int"


def source(spark, low, high):
    year = F.when(F.col("id") % 10 < 9, 2020 + F.col("id") % 3).cast("int")
    return spark.range(low, high).select("id", F.concat(F.lit("v"), "id").alias("v"), year.alias("year"))


@pytest.fixture()
def table(spark, tmp_path):
    return BatchTable(spark, str(tmp_path / "facts"), source(spark, 0, 1).schema, ["year"])


def run(spark, table):
    for batch in range(4):
        table.load(f"ids from {batch * 50}", source(spark, batch * 50, batch * 50 + 50))


@pytest.mark.parametrize("step", ["_stage", "_verify", "_publish", "after"])
def test_a_run_can_end_anywhere(spark, table, rows, monkeypatch, step):
    """The third batch is broken off after the named step; readers see two batches, the next run the whole."""
    method = "_publish" if step == "after" else step
    real = getattr(BatchTable, method)

    def dies(self, batch, *args):
        if batch == "ids from 100" and method != step:
            raise KeyboardInterrupt
        done = real(self, batch, *args)
        if batch == "ids from 100":
            raise KeyboardInterrupt
        return done

    def dies_before(self, batch, *args):
        if batch == "ids from 100":
            raise KeyboardInterrupt
        return real(self, batch, *args)

    monkeypatch.setattr(BatchTable, method, dies_before if step == "_publish" else (real if step == "after" else dies))
    if step == "after":
        later = BatchTable.load

        def load(self, batch, frame):
            done = later(self, batch, frame)
            if batch == "ids from 100":
                raise KeyboardInterrupt
            return done

        monkeypatch.setattr(BatchTable, "load", load)
    with pytest.raises(KeyboardInterrupt):
        run(spark, table)
    monkeypatch.undo()
    seen = 150 if step == "after" else 100
    assert rows(table.read()) == rows(source(spark, 0, seen))
    run(spark, table)
    assert rows(table.read()) == rows(source(spark, 0, 200))
    assert set(table.published().values()) == {50}


def test_a_batch_that_lost_rows_is_not_published(spark, table, monkeypatch):
    real = BatchTable._stage
    monkeypatch.setattr(BatchTable, "_stage", lambda self, batch, rows: real(self, batch, rows) + 1)
    with pytest.raises(ValueError, match="51 rows written, 50 found"):
        table.load("first", source(spark, 0, 50))
    assert table.published() == {} and table.read().count() == 0


def test_two_runs_cannot_publish_one_batch(spark, table):
    table.load("a/b c", source(spark, 0, 50))
    assert table.load("a/b c", source(spark, 0, 20)) == 50
    with pytest.raises(Exception, match="already exists|AlreadyExists"):
        table._publish("a/b c", 1)


def test_late_rows_are_found_in_their_years(spark, table, rows, plan):
    table.load("first", source(spark, 0, 90).where("id not in (3, 19, 40)"))
    wanted = source(spark, 0, 95).where("year = 2020 or year is null")
    late = table.unloaded(wanted, ["id"])
    assert {r.id for r in late.collect()} == {3, 19} | {r.id for r in wanted.where("id >= 90").collect()} | ({40} if 40 % 3 == 0 else set())
    text = plan(late)
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "2020" in filters and "2021" not in filters and "isnull(year" in filters
    table.load("late", late)
    assert table.unloaded(wanted, ["id"]).count() == 0
    assert rows(table.read().where("id = 19")) == [(19, "v19", None)]


def test_empty_batches_and_no_folders(spark, tmp_path):
    flat = BatchTable(spark, str(tmp_path / "flat"), source(spark, 0, 1).schema)
    assert flat.read().count() == 0 and flat.load("nothing", source(spark, 0, 0)) == 0
    assert flat.load("none", spark.createDataFrame([], source(spark, 0, 1).schema)) == 0
    assert flat.load("some", source(spark, 0, 7)) == 7 and flat.read().count() == 7
    assert flat.unloaded(source(spark, 0, 9), ["id"]).count() == 2
