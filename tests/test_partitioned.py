"""Changes to stored tables that touch only the partitions they change."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wheelhouse.operators import mutate
from wheelhouse.operators.mutate import incoming
from wheelhouse.operators.partitioned import PartitionedTable

SCHEMA = "id int, v int, year int, zone string"
ROWS = [(i, i * 10, [2020, 2021, 2022, None][i % 4], ["a b/%", None, "ü"][i % 3]) for i in range(24)]


def files(path):
    return {str(p.relative_to(path)): os.stat(p).st_mtime_ns for p in Path(path).rglob("*.parquet")}


def folder_files(state, folder):
    return {name: time for name, time in state.items() if name.startswith(folder)}


@pytest.fixture()
def table(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    out = PartitionedTable(spark, str(tmp_path / "t"), ["year", "zone"], rows.schema)
    out.write(rows)
    return out


def test_update_touches_its_partitions_only(spark, table, rows):
    before = files(table.path)
    written = table.update_where(F.col("id").isin(0, 12), {"v": F.lit(-1)})
    assert written == [{"year": 2020, "zone": "a b/%"}]
    after = files(table.path)
    assert rows(table.read()) == rows(mutate.update_where(spark.createDataFrame(ROWS, SCHEMA), F.col("id").isin(0, 12), {"v": F.lit(-1)}))
    changed = {name for name in before if after.get(name) != before[name]}
    assert changed and all(name.startswith("year=2020/zone=a b") for name in changed)


def test_update_moves_rows_to_other_partitions(spark, table, rows):
    values = {"year": F.lit(2022), "zone": F.lit("ü"), "v": F.col("v") + 1}
    table.update_where(F.col("id") < 4, values)
    assert rows(table.read()) == rows(mutate.update_where(spark.createDataFrame(ROWS, SCHEMA), F.col("id") < 4, values))


@pytest.mark.parametrize(
    "condition", ["year = 2021", "year is null and zone = 'a b/%'", "zone is null", "v >= 0", "v > 200", "v < 0"]
)
def test_delete_and_emptied_partitions(spark, table, rows, condition):
    before, condition = files(table.path), F.expr(condition)
    touched = table.delete_where(condition)
    assert rows(table.read()) == rows(mutate.delete_where(spark.createDataFrame(ROWS, SCHEMA), condition))
    whole = spark.createDataFrame(ROWS, SCHEMA)
    hit = {(r.year, r.zone) for r in whole.where(condition).collect()}
    assert {(p["year"], p["zone"]) for p in touched} == hit
    kept = [name for name, time in files(table.path).items() if before.get(name) == time]
    assert len({os.path.dirname(name) for name in kept}) == len({(y, z) for _, _, y, z in ROWS}) - len(hit)


def test_merge_is_the_whole_merge(spark, table, rows):
    source = spark.createDataFrame([(0, 7, 2020, "a b/%"), (5, 8, 2021, "ü"), (100, 1, 2021, None), (101, 2, 2030, "new"), (None, 3, 2030, "new")], SCHEMA)
    update = {"v": incoming("v")}
    before = files(table.path)
    written = table.merge(source, ["id"], update=update)
    assert rows(table.read()) == rows(mutate.merge(spark.createDataFrame(ROWS, SCHEMA), source, ["id"], update=update))
    assert sorted((str(p["year"]), str(p["zone"])) for p in written) == [("2020", "a b/%"), ("2021", "None"), ("2021", "ü"), ("2030", "new")]
    after = files(table.path)
    assert folder_files(before, "year=2022") == folder_files(after, "year=2022") != {}


def test_merge_refuses_an_ambiguous_source(spark, table, rows):
    source = spark.createDataFrame([(0, 7, 2020, "x"), (0, 8, 2020, "x")], SCHEMA)
    with pytest.raises(Exception, match="several source rows"):
        table.merge(source, ["id"], update={"v": incoming("v")})
    assert rows(table.read()) == rows(spark.createDataFrame(ROWS, SCHEMA))


def test_nothing_to_do(spark, table):
    before = files(table.path)
    assert table.update_where(F.col("id") > 99, {"v": F.lit(0)}) == []
    assert table.merge(spark.createDataFrame([], SCHEMA), ["id"], update={"v": incoming("v")}) == []
    assert files(table.path) == before


def test_changes_read_only_their_partitions(spark, table, plan):
    from wheelhouse.operators.partitioned import in_partitions

    text = plan(table.read().where(in_partitions([{"year": 2020, "zone": None}], ["year", "zone"])))
    assert "PartitionFilters: []" not in text and "DataFilters: []" in text
