"""As-of lookup in one ordered pass over facts and versions together."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wheelhouse.operators.hot_keys import HotKeys, hot_keys

SLICES = 64


def _timeline(facts: DataFrame, versions: DataFrame, fact_key: str, version_key: str, at: str, start: str, end: str, take: Mapping[str, str]) -> DataFrame:
    """Facts and versions as rows (key, time, is_version, fact, version), without what can never match."""
    known = facts.where(F.col(fact_key).isNotNull() & F.col(at).isNotNull())
    lasting = versions.where(F.col(version_key).isNotNull() & (F.col(start) < F.col(end)))
    version = F.struct(F.col(start).alias("__start"), F.col(end).alias("__end"), *(F.col(c).alias(name) for name, c in take.items()))
    events = lasting.select(F.col(version_key).alias("__key"), F.col(start).alias("__time"), F.lit(True).alias("__is_version"), version.alias("__version"))
    asked = known.select(F.col(fact_key).alias("__key"), F.col(at).alias("__time"), F.lit(False).alias("__is_version"), F.struct(*facts.columns).alias("__fact"))
    return asked.unionByName(events, allowMissingColumns=True)


def _borders(timeline: DataFrame, hot: HotKeys) -> DataFrame:
    """(key, cuts): for every frequent key, moments that divide its rows into about equal slices."""
    steps = [i / SLICES for i in range(1, SLICES)]
    cuts = F.array_distinct(F.percentile_approx("__time", steps, 1000)).alias("__cuts")
    return timeline.where(hot.holds()).groupBy(F.col("__key").alias("__hot_key")).agg(cuts)


def asof_ordered(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    version_key: str,
    at: str,
    start: str,
    end: str,
    take: Mapping[str, str],
    share: float = 0.001,
    min_rows: int = 100_000,
) -> DataFrame:
    """Left as-of lookup: for every fact the version with ``start < at <= end``, of which there must be at most one.

    Facts and versions are put in one order by key and time, and every fact takes the last version that began before it.
    Each row is moved once, whatever the number of versions of a key; :func:`wheelhouse.operators.joins.valid_at`
    compares pairs instead and also takes versions that overlap.  Here two versions of a key that overlap are an error.

    A key with more than ``share`` of all rows, and ``min_rows`` of them, is cut by time into :data:`SLICES` slices,
    which different tasks read.  What was valid when a slice begins is the last version of the slices before it, one row
    for each slice, and comes from a small table.  Facts without key or moment keep their row and find nothing; versions
    that end before they begin, or lack a key, a start or an end, are never valid.
    """
    kept = [c for c in facts.columns if c not in take]
    rows = _timeline(facts, versions, fact_key, version_key, at, start, end, take)
    (hot,) = hot_keys(rows, ["__key"], share=share, min_rows=min_rows)
    if hot.counts:
        # At most 1 / share keys of SLICES moments each: about a megabyte.
        borders = F.broadcast(_borders(rows, hot))
        cut = rows.join(borders, F.col("__key") == F.col("__hot_key"), "left").drop("__hot_key")
        before = F.size(F.filter("__cuts", lambda c: c < F.col("__time")))
        rows = cut.withColumn("__slice", F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(before)).drop("__cuts")
    else:
        rows = rows.withColumn("__slice", F.lit(0))

    # At one moment facts come before versions, as a version is valid only after its start.
    order = Window.partitionBy("__key", "__slice").orderBy("__time", "__is_version")
    earlier = F.last("__version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("__before", earlier)
    if hot.counts:
        rows = _with_carried(rows, hot)

    overlap = F.raise_error(F.concat(F.lit("versions of one key overlap: "), F.col("__key").cast("string"))).cast("boolean")
    clash = F.col("__before.__end") > F.col("__time")
    only_facts = F.when(~F.col("__is_version"), F.lit(True)).when(clash, overlap).otherwise(F.lit(False))
    valid = F.col("__time") <= F.col("__before.__end")
    found = rows.where(only_facts).select(
        *(F.col(f"__fact.{c}").alias(c) for c in kept), *(F.when(valid, F.col(f"__before.{name}")).alias(name) for name in take)
    )
    kinds = {name: found.schema[name].dataType for name in take}
    unasked = facts.where(F.col(fact_key).isNull() | F.col(at).isNull())
    return found.unionByName(unasked.select(*kept, *(F.lit(None).cast(kinds[name]).alias(name) for name in take)))


def _with_carried(rows: DataFrame, hot: HotKeys) -> DataFrame:
    """``rows`` of frequent keys that have no version before them in their slice take the last one of earlier slices."""
    last = rows.where(hot.holds(["__key"]) & F.col("__is_version")).groupBy("__key", "__slice").agg(
        F.max_by("__version", F.struct("__time", F.col("__version.__end"))).alias("version")
    )
    by_slice = last.groupBy(F.col("__key").alias("__carried_key")).agg(F.collect_list(F.struct("__slice", "version")).alias("__lasts"))
    carried = rows.join(F.broadcast(by_slice), F.col("__key") == F.col("__carried_key"), "left")
    older = F.filter("__lasts", lambda x: x["__slice"] < F.col("__slice"))
    nearest: Column = F.aggregate(older, F.get(older, F.lit(0)), lambda a, b: F.when(b["__slice"] > a["__slice"], b).otherwise(a))["version"]
    return carried.withColumn("__before", F.coalesce("__before", nearest)).drop("__carried_key", "__lasts")
