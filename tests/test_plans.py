"""Plans: what must not appear in any of them, and what the important ones must look like."""

import re

import pytest
from pyspark.sql import functions as F

from tests.compare import DATA
from wheelhouse import catalog
from wheelhouse.catalog.bindings import Tables
from wheelhouse.catalog.marts import fact_rides
from wheelhouse.operators import mutate
from wheelhouse.plans import rides

FOLDER = str(DATA / "sf0.001")
QUERIES = catalog.QUERIES
# Windows number the ranges of dense keys (bounded by the number of ranges, see the operator), and order facts and
# versions within a slice of a key's time.
WINDOWED = {"dense_surrogate_key", "join_asof_long_histories", "join_asof_hot_key"}
FORBIDDEN = ["CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "Scan ExistingRDD"]


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["join_self_role", "join_left_default_member", "join_on_derived_keys", "join_fact_dims_inner", "distance_with_fallback"])
def test_measured_dimensions_move_no_fact(spark, plan, no_broadcast, name):
    """Dimensions that are joins themselves are measured, so that the rides pass through without a shuffle."""
    spine = [line for line in plan(QUERIES[name](spark, FOLDER)).splitlines() if "SortMergeJoin" in line and re.match(r"^[ :]{0,9}\+- ", line)]
    assert spine == []


def test_only_small_scans_are_shared_out(spark):
    from wheelhouse.operators.layout import spread

    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert spread(documents).rdd.getNumPartitions() == 8
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert "RoundRobin" not in spread(documents)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if n.startswith(("stream_", "write_"))}))
def test_nothing_unscalable(spark, plan, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for node in FORBIDDEN + ([] if name in WINDOWED else ["Window "]):
        assert node not in text, node


def test_fact_load_moves_no_fact(spark, plan):
    """All dimensions of the fact load are counted small here, so rides pass through without a shuffle."""
    t = Tables(spark, FOLDER)
    text = plan(fact_rides(t))
    assert "SortMergeJoin" not in text
    spine = [line for line in text.splitlines() if re.match(r"^[ :]*\+- (\*\(\d+\) )?BroadcastHashJoin", line)]
    assert len(spine) >= 8


def test_filters_and_columns_reach_the_scan(spark, capsys):
    QUERIES["scan_parquet"](spark, FOLDER).explain("formatted")
    text = capsys.readouterr().out
    assert "GreaterThanOrEqual(l_shipdate" in text.split("PushedFilters: ")[1].splitlines()[0]
    read = text.split("ReadSchema: ")[1].splitlines()[0]
    assert read.startswith("struct<l_orderkey:bigint,l_partkey:bigint,l_shipdate:") and read.count(":") == 3


def test_rides_are_summed_before_they_are_joined(spark, plan, no_broadcast):
    """One shuffle on the subscription serves both the sum and the join."""
    t = Tables(spark, FOLDER)
    text = plan(rides.average_user_duration(t.rides, t.subscriptions))
    assert len(re.findall(r"Exchange hashpartitioning\(subscription_id", text)) == 2
    assert text.index("SortMergeJoin") < text.index("partial_sum(((")


def test_small_increment_moves_no_target_row(spark, plan):
    target = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("v"))
    source = spark.range(5).select(F.col("id").alias("k"), F.lit(0).cast("bigint").alias("v"))
    text = plan(mutate.merge(target, source, ["k"], update="all", small=True))
    updated = text.split("LeftAnti")[0]
    assert "BroadcastHashJoin" in updated and "SortMergeJoin" not in updated


def test_streams_have_bounded_state(spark):
    from wheelhouse.catalog import streams
    from wheelhouse.streaming import events

    t = Tables(spark, FOLDER)
    timed = events.with_event_time(streams.parsed_stream(t), "eventtime", "10 seconds")
    sums = events.window_sums(timed, "eventtime", "key", "value", "10 seconds")
    assert "EventTimeWatermark" in sums._jdf.queryExecution().analyzed().toString()
