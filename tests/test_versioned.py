"""Versioned tables read from snapshots."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wheelhouse.sources import versioned

SCHEMA = "k int, part string, v int"
KEYS = ["k", "part"]


def moment(version):
    return f"2024-01-{version + 1:02d} 00:00:00"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Twelve commits over thirty keys, with a snapshot after every fourth."""
    path, rng = str(tmp_path_factory.mktemp("log") / "t"), random.Random(8)
    for version in range(12):
        changed = rng.sample(range(30), 12) if version else range(30)
        rows = [(k, "ab"[k % 2], None if k == 7 else version * 100 + k, "I" if not version else rng.choice("UUD")) for k in changed]
        df = spark.createDataFrame(rows, SCHEMA + ", op string")
        log = versioned.changes(df.drop("op"), version, moment(version), "I").withColumn("_op", F.lit(None).cast("string"))
        log = versioned.changes(df, version, moment(version), F.col("op")).drop("op") if version else log.withColumn("_op", F.lit("I"))
        versioned.append_commit(log, path, KEYS, version, every=4)
    return path


def test_snapshots_are_written(spark, stored):
    assert versioned.versions(spark, stored) == list(range(12))
    assert versioned.snapshots(spark, stored) == [3, 7, 11]


@pytest.mark.parametrize("version", [*range(-1, 13), None])
def test_every_version_equals_a_full_replay(spark, stored, rows, version):
    log = versioned.read_log(spark, stored)
    got = versioned.read_at(spark, stored, KEYS, version=version)
    wanted = versioned.state_at(log, KEYS, version=version)
    assert got.columns == wanted.columns == ["k", "part", "v"] and rows(got) == rows(wanted)


@pytest.mark.parametrize("at", ["2023-01-01 00:00:00", "2024-01-01 00:00:00", "2024-01-06 23:00:00", "2024-01-12 00:00:00", "2030-01-01 00:00:00"])
def test_moments_equal_a_full_replay(spark, stored, rows, at):
    log = versioned.read_log(spark, stored)
    assert rows(versioned.read_at(spark, stored, KEYS, timestamp=at)) == rows(versioned.state_at(log, KEYS, timestamp=at))
    both = versioned.read_at(spark, stored, KEYS, version=4, timestamp=at)
    assert rows(both) == rows(versioned.state_at(log, KEYS, version=4, timestamp=at))


def test_only_the_tail_is_read(spark, stored, plan):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    got = versioned.read_at(spark, stored, KEYS, version=9)
    text = plan(got)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "_snapshots/version=7]" in text
    assert re.search(r"PartitionFilters: \[[^]]*\(_version#\d+ <= 9\)[^]]*\(_version#\d+ > 7\)", text)
    assert {int(re.search(r"_version=(\d+)", f)[1]) for r in spark.read.parquet(stored).where("_version > 7 and _version <= 9").select("_metadata.file_path").distinct().collect() for f in r} == {8, 9}


def test_a_broken_snapshot_is_passed_by(spark, stored, rows):
    log = versioned.read_log(spark, stored)
    done = Path(stored) / "_snapshots" / "version=7" / "_SUCCESS"
    done.unlink()
    try:
        assert versioned.snapshots(spark, stored) == [3, 11]
        assert rows(versioned.read_at(spark, stored, KEYS, version=8)) == rows(versioned.state_at(log, KEYS, version=8))
    finally:
        versioned.write_snapshot(spark, stored, KEYS, 7)
    assert versioned.snapshots(spark, stored) == [3, 7, 11]
    assert rows(versioned.read_at(spark, stored, KEYS, version=8)) == rows(versioned.state_at(log, KEYS, version=8))
