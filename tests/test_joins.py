"""Lookups, as-of joins, dense keys and chain checks against brute force; hot keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wheelhouse.catalog import ORACLES, QUERIES
from wheelhouse.operators import joins, keys, limits, quality

EPOCH = dt.datetime(2020, 1, 1)


def minutes(n):
    return EPOCH + dt.timedelta(minutes=n)


def brute_force(facts, versions):
    got = []
    for number, key, at in facts:
        hits = [name for k, start, end, name in versions if k == key and key is not None and start < at <= end]
        got += [(number, hit) for hit in hits] or [(number, None)]
    return sorted(got, key=str)


def histories(seed, chained):
    """One key with a long history and a third of all facts, others with a few versions."""
    rng = random.Random(seed)
    versions, facts = [], []
    for key, count in [("hot", 200)] + [(f"k{i}", rng.randint(0, 4)) for i in range(20)]:
        cuts = sorted(rng.sample(range(1000), count + 1))
        for i in range(count):
            end = cuts[i + 1] if chained else cuts[i] + rng.randint(-5, 300)
            end = 10_000_000 if chained and i == count - 1 else end
            versions.append((key, minutes(cuts[i]), minutes(end), f"{key}-{i}"))
    for number in range(300):
        key = "hot" if number % 3 == 0 else rng.choice([f"k{i}" for i in range(22)] + [None])
        facts.append((number, key, minutes(rng.randint(-50, 1100))))
    return facts, versions


@pytest.mark.parametrize("chained", [True, False])
@pytest.mark.parametrize("options", [{}, {"max_versions": 7}, {"max_versions": 1}])
def test_valid_at(spark, chained, options):
    facts, versions = histories(7, chained)
    left = spark.createDataFrame(facts, "number int, key string, at timestamp_ntz")
    right = spark.createDataFrame(versions, "key string, s timestamp_ntz, e timestamp_ntz, name string")
    got = joins.valid_at(left, right, "key", "key", "at", "s", "e", {"version": "name"}, **options)
    assert sorted(((r.number, r.version) for r in got.collect()), key=str) == brute_force(facts, versions)


def test_slices_share_out_a_long_history(spark):
    """With slices no join key value meets more than a few versions."""
    facts, versions = histories(3, True)
    right = spark.createDataFrame(versions, "key string, s timestamp_ntz, e timestamp_ntz, name string")
    long = joins._long_histories(joins._spans(right, "key", "s"), 10)
    side = right.join(long, F.col("key") == F.col("__long_key"), "left").withColumn(
        "slice", F.explode(F.sequence(joins._slice_of(F.col("s")), joins._slice_of(F.col("e"))))
    )
    largest = side.groupBy("key", "slice").count().agg(F.max("count")).first()[0]
    assert largest < 40 and side.count() < 2 * len(versions) + 20


def test_interval_is_open_at_its_start(spark, rows):
    facts = spark.createDataFrame([(1, "a", minutes(0)), (2, "a", minutes(5))], "n int, key string, at timestamp_ntz")
    versions = spark.createDataFrame([("a", minutes(0), minutes(5), "v")], "key string, s timestamp_ntz, e timestamp_ntz, name string")
    got = joins.valid_at(facts, versions, "key", "key", "at", "s", "e", {"v": "name"})
    assert rows(got.select("n", "v")) == [(1, None), (2, "v")]


def test_lookup_keeps_every_fact(spark, rows):
    facts = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "n int, key int")
    dim = spark.createDataFrame([(10, 7, True), (10, 8, False), (None, 9, True)], "id int, sk int, live boolean")
    got = joins.lookup(facts, dim, {"key": "id"}, {"sk": "sk"}, default=-1, only=F.col("live"))
    assert rows(got) == [(1, 10, 7), (2, None, -1), (3, 99, -1)]


def test_lookup_may_replace_its_own_key(spark, rows):
    facts = spark.createDataFrame([(1, 10), (2, 11)], "n int, id int")
    dim = spark.createDataFrame([(10,)], "id int")
    assert rows(joins.lookup(facts, dim, {"id": "id"}, {"id": "id"}, default=-1)) == [(1, 10), (2, -1)]


def test_unmatched_keeps_null_keys(spark, rows):
    source = spark.createDataFrame([(1, 1), (None, 2), (3, 3)], "k int, v int")
    assert rows(joins.unmatched(source, source.where("k = 1"), ["k"])) == [(None, 2), (3, 3)]


def test_sized_broadcasts_only_what_is_counted_small(spark, final_plan):
    facts = spark.range(1000).select(F.col("id"), (F.col("id") % 50).alias("key"))
    dim = spark.range(50).select(F.col("id").alias("key"), F.col("id").alias("sk"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [
            final_plan(joins.lookup(facts, joins.sized(dim, max_bytes=bound)[0], {"key": "key"}, {"sk": "sk"})) for bound in (50 * 32, 50 * 32 - 1)
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans[0]
    assert "SortMergeJoin" in plans[1] and "BroadcastHashJoin" not in plans[1]


SMALL_SKEW = {
    "spark.sql.shuffle.partitions": "20",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def small_skew(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL_SKEW}
    for name, value in SMALL_SKEW.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_hot_key_is_split_in_a_lookup(spark, small_skew, final_plan):
    """A third of all facts on one key: its partition is read by several tasks."""
    facts = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("key"),
        F.sha2(F.col("id").cast("string"), 256).alias("load"),
    )
    dim = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("key"), (F.col("id") * 2).alias("sk"))
    found = joins.lookup(facts, dim, {"key": "key"}, {"sk": "sk"}).groupBy("key").agg(F.count("sk").alias("n"), F.max("load"))
    assert "skew=true" in final_plan(found)
    assert found.where("key = 0").first().n == 20_000


# --- keys ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["bigint", "string", "date"])
def test_dense_keys(spark, kind):
    base = spark.range(40).select((F.col("id") * 37 % 41).alias("n"))
    key = F.date_add(F.lit("2020-01-01").cast("date"), F.col("n").cast("int")) if kind == "date" else F.col("n").cast(kind)
    df = base.union(base).union(spark.range(1).select(F.lit(None))).select(key.alias("k"))
    got = sorted((r.sk, r.k) for r in keys.dense_keys(df, "k", "sk").collect())
    assert [sk for sk, _ in got] == list(range(1, 41))
    assert [k for _, k in got] == sorted(k for _, k in got)


def test_dense_keys_of_nothing(spark):
    assert keys.dense_keys(spark.range(0), "id", "sk").count() == 0


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), (None, 1, "q")], "k string, t int, v string")
    assert rows(keys.latest_per_key(df, ["k"], [F.col("t"), F.col("v")])) == [(None, 1, "q"), ("a", 2, "z"), ("b", None, "n")]


@pytest.mark.parametrize(
    ("versions", "sound"),
    [
        ([(0, 5, False), (5, 9, True)], True),
        ([(0, 9, True)], True),
        ([(0, 4, False), (5, 9, True)], False),  # gap
        ([(0, 6, False), (5, 9, True)], False),  # overlap
        ([(0, 5, True), (5, 9, True)], False),  # two current
        ([(0, 5, False), (5, 9, False)], False),  # none current
        ([(0, 5, False), (0, 5, False), (5, 9, True)], False),  # repeated
        ([(5, 0, True)], False),  # backwards
    ],
)
def test_version_chains(spark, versions, sound):
    df = spark.createDataFrame(
        [(1, minutes(s), minutes(e), c) for s, e, c in versions], "k int, s timestamp_ntz, e timestamp_ntz, c boolean"
    )
    assert keys.version_chains(df, "k", "s", "e", "c").first().is_sound is sound


# --- limits and constraints ----------------------------------------------------------------------


@pytest.mark.parametrize(("min_rows", "days"), [(1, 2), (3, 3), (5, 10), (99, 10)])
def test_widening_window(spark, min_rows, days):
    stamps = [EPOCH + dt.timedelta(days=d, hours=h) for d, h in [(0, 1), (1, 23), (2, 5), (6, 0), (9, 23), (10, 0), (-1, 23)]]
    df = spark.createDataFrame([(s,) for s in stamps], "at timestamp_ntz")
    got = limits.widening_window(df, "at", "2020-01-01", (2, 3, 10), min_rows)
    expected = [s for s in stamps if dt.timedelta(0) <= s - EPOCH < dt.timedelta(days=days)]
    assert sorted(r.at for r in got.collect()) == sorted(expected)


def test_watermark_of_an_empty_load(spark):
    source = spark.range(5)
    assert limits.above_watermark(source, source.where("id < 0"), "id", "id").count() == 4


def test_constraints(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "k int, v string")
    assert rows(quality.duplicate_keys(df, ["k"])) == [(None, 1), (1, 2)]
    assert rows(quality.null_counts(df, ["k", "v"])) == [("k", 1), ("v", 1)]
    assert rows(quality.orphans(df, "k", spark.createDataFrame([(2,)], "id int"), "id")) == [(1, 2)]
    assert rows(quality.outside_set(df, "v", ["a", "b"])) == [(None, "c")]


def test_parents_of_a_constraint_are_not_broadcast(spark, rows, final_plan):
    """However small Spark takes them to be: values are counted first, and the counts meet the parents sorted."""
    child = spark.range(1000).select(F.when(F.col("id") % 7 != 0, F.concat(F.lit("s-"), F.col("id") % 10)).alias("k"))
    parent = spark.createDataFrame([("s-0",), ("s-1",), ("s-1",), (None,)], "id string")
    got = quality.orphans(child, "k", parent, "id")
    wanted = [(f"s-{k}", sum(n % 7 != 0 for n in range(k, 1000, 10))) for k in range(2, 10)]
    assert got.columns == ["key", "row_count"] and rows(got) == wanted
    text = final_plan(got)
    assert "BroadcastHashJoin" not in text and text.index("LeftAnti") < text.index("partial_count")


def test_cap_is_that_of_the_export(spark, tmp_path):
    """Rides come in any order; all 15,000 that the export takes are there, the lowest numbers first."""
    orders = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("o_orderkey"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("o_orderdate"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    assert [r.ride_id for r in QUERIES["limit_cap"](spark, str(tmp_path)).collect()] == list(range(15_000))
    assert "LIMIT 15000" in ORACLES["limit_cap"]


# --- as-of lookups far outside ordinary histories --------------------------------------------------


def _asof(spark, versions, facts, **options):
    v = spark.createDataFrame(versions, "k int, s string, e string, name int").withColumns(
        {"s": F.col("s").cast("timestamp_ntz"), "e": F.col("e").cast("timestamp_ntz")}
    )
    f = spark.createDataFrame(facts, "k int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = joins.valid_at(f, v, "k", "k", "at", "s", "e", {"name": "name"}, **options)
    return sorted(tuple(map(str, r)) for r in got.collect())


@pytest.mark.parametrize("limit", [1, 10, 5000])
def test_asof_gives_the_same_for_every_slice_size(spark, limit):
    shared = [(1, "2020-01-01 00:00:00", "2100-01-01 00:00:00", i) for i in range(200)]
    short = [(2, f"2020-01-01 00:00:00.{i:03d}", "2100-01-01 00:00:00", i) for i in range(30)] + [(2, "2020-01-01 00:00:01", "2100-01-01 00:00:00", 99)]
    chain = [(3, f"20{i:02d}-01-01 00:00:00", f"20{i + 1:02d}-01-01 00:00:00", i) for i in range(10, 60)]
    facts = [(k, at) for k in (1, 2, 3, 4, None) for at in ("1995-01-01 00:00:00", "2020-01-01 00:00:00.010", "2045-06-01 00:00:00", "2125-01-01 00:00:00")]
    wanted = []
    for k, at in facts:
        found = [n for key, s, e, n in shared + short + chain if key == k and s < at <= e]
        wanted += [(str(k), at.ljust(26, "0") if "." in at else at, str(n)) for n in found] or [(str(k), at.ljust(26, "0") if "." in at else at, "None")]
    assert _asof(spark, shared + short + chain, facts, max_versions=limit) == sorted(wanted)


def test_one_long_key_keeps_the_versions_broadcast(spark, plan):
    v = spark.range(5000).select(
        F.lit(1).alias("k"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("s"), F.timestamp_seconds(F.col("id") + 1).cast("timestamp_ntz").alias("e")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = spark.range(10).select(F.lit(1).alias("k"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("at"))
        text = plan(joins.valid_at(f, v, "k", "k", "at", "s", "e", {"began": "s"}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in text.split("BroadcastExchange")[0]
