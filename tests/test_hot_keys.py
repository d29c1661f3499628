"""Lookups with frequent keys, and the as-of lookup in one ordered pass."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from wheelhouse.operators import joins
from wheelhouse.operators.hot_keys import HotKeys, hot_keys, lookup_hot
from wheelhouse.operators.ordered import asof_ordered

EPOCH = dt.datetime(2020, 1, 1)


def shown(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


@pytest.fixture()
def skewed(spark):
    """100,000 facts: two in five with key 7, one in five without a key."""
    n = F.col("id")
    key = F.when(n % 5 < 2, F.lit(7)).when(n % 5 > 2, n)
    return spark.range(0, 100_000, 1, 8).select(n.alias("fact"), key.alias("k"), F.lit("x").alias("name"))


@pytest.fixture()
def no_broadcast(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_sketch_finds_the_frequent_key(spark, skewed):
    none, one = hot_keys(skewed, ["fact"], ["k"], share=0.01)
    assert none.counts == {} and len(one.counts) == 1
    assert skewed.where(one.holds()).select("k").distinct().collect() == [(7,)]
    assert list(one.counts.values()) == [40_000]


def test_no_task_holds_the_hot_key(spark, skewed, no_broadcast, plan):
    dimension = spark.range(0, 100_000, 1, 4).select(F.col("id").alias("id"), (F.col("id") * 2).alias("sk"))
    found = lookup_hot(skewed, dimension, {"k": "id"}, {"sk": "sk"})
    assert found.where("sk = 14").count() == 40_000 and found.where("k is null and sk is null").count() == 20_000
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * statistics.median(sizes)
    text = plan(found)
    assert text.count("SortMergeJoin") == 1 and text.count("BroadcastHashJoin") == 1


@pytest.mark.parametrize("default", [None, -1])
@pytest.mark.parametrize("chosen", ["measured", "none", "all"])
def test_ways_agree_with_one_join(spark, default, chosen):
    rng = random.Random(3)
    facts = [(i, rng.choice([None, 1, 1, 1, 2, 3, 4]), rng.choice([None, "a", "a", "b"]), 5) for i in range(400)]
    facts = spark.createDataFrame(facts, "fact int, k int, c string, sk int")
    members = [(1, "a", 10, True), (1, "a", 11, True), (1, "b", 12, False), (2, "a", 13, True), (None, "a", 14, True), (3, None, 15, True)]
    dimension = spark.createDataFrame(members, "id int, code string, sk int, current boolean")
    on, take = {"k": "id", "c": "code"}, {"sk": "sk"}
    hot = None
    if chosen != "measured":
        hashes = [r[0] for r in facts.select(F.xxhash64("k", "c")).distinct().collect()] if chosen == "all" else []
        hot = HotKeys(("k", "c"), dict.fromkeys(hashes, 1))
    wanted = joins.lookup(facts, dimension, on, take, default=default, only=F.col("current"))
    got = lookup_hot(facts, dimension, on, take, hot=hot, default=default, only=F.col("current"))
    assert got.dtypes == wanted.dtypes and shown(got) == shown(wanted)


def test_lookup_of_nothing(spark):
    facts = spark.createDataFrame([], "k int, v string")
    dimension = spark.createDataFrame([(1, 2)], "id int, sk int")
    assert lookup_hot(facts, dimension, {"k": "id"}, {"sk": "sk"}).count() == 0
    assert shown(lookup_hot(spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string"), dimension.limit(0), {"k": "id"}, {"sk": "sk"})) == [
        ("1", "b", "None"),
        ("None", "a", "None"),
    ]


def test_keys_of_other_columns_are_refused(spark, skewed):
    (hot,) = hot_keys(skewed, ["fact"])
    with pytest.raises(ValueError, match="do not fit"):
        lookup_hot(skewed, spark.range(1), {"k": "id"}, {"sk": "id"}, hot=hot)


# --- as of, in one ordered pass --------------------------------------------------------------------


def histories(spark, seed):
    rng = random.Random(seed)
    versions, facts = [], []
    for key, length in ((1, 120), (2, 3), (3, 1), (4, 40)):
        moment = 0
        for i in range(length):
            moment += rng.choice([0, 0, 5])  # gaps between some versions
            end = moment + rng.randrange(1, 9)
            versions.append((key, moment, end, f"{key}-{i}"))
            moment = end
    versions += [(1, 10, 10, "empty"), (1, 20, 4, "backwards"), (None, 0, 99, "nobody"), (5, None, 9, "open")]
    for i in range(900):
        facts.append((i, rng.choice([1, 1, 1, 2, 3, 4, 6, None]), rng.choice([None, *range(-3, 600)]), "old"))
    minute = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(1))
    base = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    v = spark.createDataFrame(versions, "k int, s int, e int, name string").select("k", (base + minute * F.col("s")).alias("s"), (base + minute * F.col("e")).alias("e"), "name")
    f = spark.createDataFrame(facts, "fact int, k int, at int, name string").select("fact", "k", (base + minute * F.col("at")).alias("at"), "name")
    return f, v


@pytest.mark.parametrize(("share", "min_rows"), [(0.001, 100_000), (0.001, 1), (0.2, 1)])
def test_ordered_pass_equals_pairs(spark, share, min_rows):
    facts, versions = histories(spark, 5)
    args = (facts, versions, "k", "k", "at", "s", "e", {"name": "name", "since": "s"})
    wanted, got = joins.valid_at(*args), asof_ordered(*args, share=share, min_rows=min_rows)
    assert got.dtypes == wanted.dtypes and shown(got) == shown(wanted)


@pytest.mark.parametrize("min_rows", [100_000, 1])
def test_overlaps_are_refused(spark, min_rows):
    facts, versions = histories(spark, 6)
    again = versions.where("name = '1-60'").withColumn("name", F.lit("again"))
    with pytest.raises(Exception, match="versions of one key overlap"):
        asof_ordered(facts, versions.union(again), "k", "k", "at", "s", "e", {"name": "name"}, min_rows=min_rows).count()


def test_many_versions_of_one_key_take_linear_work(spark):
    """A million versions of one key: as many rows in the ordered pass as facts and versions together."""
    second = F.timestamp_seconds(F.col("id")).cast("timestamp_ntz")
    versions = spark.range(0, 1_000_000, 1, 8).select(F.lit(1).alias("k"), second.alias("s"), F.timestamp_seconds(F.col("id") + 1).cast("timestamp_ntz").alias("e"), F.col("id").alias("n"))
    facts = spark.range(0, 50_000, 1, 4).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 20 + 1).cast("timestamp_ntz").alias("at"), F.col("id").alias("fact"))
    found = asof_ordered(facts, versions, "k", "k", "at", "s", "e", {"n": "n"})
    assert found.agg(F.count_if(F.col("n") == F.col("fact") * 20)).first()[0] == 50_000


def test_ordered_pass_over_nothing(spark):
    facts, versions = histories(spark, 7)
    take = {"found": "name"}
    assert asof_ordered(facts.limit(0), versions, "k", "k", "at", "s", "e", take).count() == 0
    assert asof_ordered(facts, versions.limit(0), "k", "k", "at", "s", "e", take).where("found is not null").count() == 0
