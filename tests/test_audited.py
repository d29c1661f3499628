"""Batches that are audited while they are written."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wheelhouse.sinks.audited import AuditedTable, AuditFailed, known_keys

SCHEMA = "id long, v int, year int"


def rules():
    return {"negative": F.col("v") < 0, "no value": F.col("v").isNull(), "old": F.col("year") < 2020, "no parent": ~F.col("known")}


def source(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    parents = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "key long")
    return known_keys(df, "id", parents, "key", "known")


@pytest.fixture()
def make(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return lambda **options: AuditedTable(spark, str(tmp_path / "t"), schema, rules(), by=["year"], **options)


GOOD = [(1, 5, 2020), (2, 0, 2021), (None, 7, None), (3, 1, 2021)]
BAD = [(1, -5, 2019), (9, None, 2020), (2, 4, 1999)]


def test_a_clean_batch_is_published(spark, make, rows):
    table = make()
    assert table.load("one", source(spark, GOOD)) == 4
    assert rows(table.read()) == rows(spark.createDataFrame(GOOD, SCHEMA)) and table.quarantine("one").count() == 0


def test_a_bad_batch_is_not_published(spark, make, rows):
    table = make()
    table.load("one", source(spark, GOOD))
    with pytest.raises(AuditFailed, match="3 bad rows") as failure:
        table.load("two", source(spark, GOOD[:2] + BAD))
    assert failure.value.broken == {"negative": 1, "no value": 1, "old": 2, "no parent": 1} and failure.value.bad == 3
    assert table.published() == {"one": 4} and table.read().count() == 4
    got = {r.id: r.reasons for r in table.quarantine("two").collect()}
    assert got == {1: ["negative", "old"], 9: ["no value", "no parent"], 2: ["old"]}
    assert table.load("two", source(spark, GOOD[:2])) == 2  # mended
    assert table.read().count() == 6 and table.quarantine("two").count() == 0


def test_some_bad_rows_can_be_allowed(spark, make, rows):
    table = make(allowed=3)
    assert table.load("one", source(spark, GOOD + BAD)) == 4
    assert rows(table.read()) == rows(spark.createDataFrame(GOOD, SCHEMA)) and table.quarantine("one").count() == 3
    with pytest.raises(AuditFailed):
        table.load("two", source(spark, BAD + BAD[:1]))


def test_one_pass_reads_and_counts(spark, make):
    """The source is read once: every row passes the counting column a single time."""
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    table = make(allowed=99)
    rows = source(spark, GOOD + BAD)
    assert table.load("one", rows.mapInArrow(count, rows.schema)) == 4
    assert passed.value == 7


def test_empty_batches(spark, make):
    table = make()
    assert table.load("none", source(spark, [])) == 0 and table.read().count() == 0 and table.quarantine("none").count() == 0
