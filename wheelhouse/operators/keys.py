"""Latest row per key, dense keys and checks of version chains, without gathering a key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wheelhouse.sinks.files import staged


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the greatest ``order`` values per key.

    The same as keeping ``row_number() = 1`` of a descending window, but as an aggregation: every map
    task passes on at most one row per key, so a hot key costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order))))
    picked = df.groupBy(*keys).agg(best.alias("__best"))
    return picked.select(*(F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in df.columns))


def dense_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """Number the distinct values of ``key`` 1, 2, 3, ... in ascending order.

    A single ordered window would put the whole table into one task.  Instead the keys are dealt out by
    range and sorted, every row takes its place within its task, and the places are shifted by the number
    of keys in the tasks before.  The ranges decide how even the tasks are, never the result.
    """
    values = df.where(F.col(key).isNotNull()).select(key).distinct()
    # The id holds the number of the task in its upper bits and the place within the task in the lower 33.
    ordered = values.repartitionByRange(key).sortWithinPartitions(key).withColumn("__id", F.monotonically_increasing_id())
    placed = staged(ordered, "dense-keys").select(
        key, F.shiftright("__id", 33).alias("__task"), F.col("__id").bitwiseAND((1 << 33) - 1).alias("__place")
    )
    # One row per task, so this ordered window and the broadcast are as small as the number of tasks.
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    shift = placed.groupBy("__task").agg(F.count(F.lit(1)).alias("__n")).select(
        "__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    return placed.join(F.broadcast(shift), "__task").select(key, (F.col("__place") + F.col("__before") + 1).alias(name))


def version_chains(df: DataFrame, key: str, start: str, end: str, current: str) -> DataFrame:
    """Check that the versions of every key form one unbroken chain with one current version.

    Chains are checked by their joints: the moments where versions of a key start and end.  In a sound
    history exactly one start has no version ending there, and exactly one end no version starting there.
    Joints are counted by (key, moment) first, so a key with many versions is spread by its moments.
    """
    joints = df.select(
        F.col(key).alias("key"),
        (F.col(current)).cast("int").alias("is_current"),
        (F.col(start) >= F.col(end)).cast("int").alias("is_backward"),
        F.explode(
            F.array(
                F.struct(F.col(start).alias("at"), F.lit(1).alias("starts"), F.lit(0).alias("ends")),
                F.struct(F.col(end).alias("at"), F.lit(0).alias("starts"), F.lit(1).alias("ends")),
            )
        ).alias("joint"),
    )
    by_moment = joints.groupBy("key", "joint.at").agg(
        F.sum("joint.starts").alias("starts"),
        F.sum("joint.ends").alias("ends"),
        F.sum(F.col("is_current") * F.col("joint.starts")).alias("currents"),
        F.sum(F.col("is_backward") * F.col("joint.starts")).alias("backward"),
    )
    by_key = by_moment.groupBy("key").agg(
        F.sum("starts").alias("versions"),
        F.sum("currents").alias("currents"),
        F.sum("backward").alias("backward"),
        F.count_if((F.col("starts") > 0) & (F.col("ends") == 0)).alias("heads"),
        F.count_if((F.col("ends") > 0) & (F.col("starts") == 0)).alias("tails"),
        F.count_if((F.col("starts") > 1) | (F.col("ends") > 1)).alias("clashes"),
    )
    sound = (
        (F.col("currents") == 1)
        & (F.col("backward") == 0)
        & (F.col("heads") == 1)
        & (F.col("tails") == 1)
        & (F.col("clashes") == 0)
    )
    return by_key.select(F.col("key").alias(key), "versions", "currents", "heads", sound.alias("is_sound"))
