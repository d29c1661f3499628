"""Lookups into dimensions.

A dimension is broadcast only when its size is known: bounded by construction, measured by :func:`sized`, or
below Spark's own threshold.  Any other one is joined by a shuffle, where adaptive execution splits the
partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN_KEY = -1
BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory: strings as long as they are, other columns 16 each."""
    sizes = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 16
        if f.dataType.typeName() in ("string", "binary")
        else F.lit(16)
        for f in df.schema.fields
    ]
    return reduce(lambda a, b: a + b, sizes, F.lit(0)).cast("long")


def sized(*dimensions: DataFrame, max_bytes: int = BROADCAST_BYTES) -> list[DataFrame]:
    """Mark the dimensions for broadcast that are measured to hold at most ``max_bytes``.

    Spark multiplies the sizes of joined inputs when it plans, so a small dimension that is itself a join
    looks huge, and every fact would be shuffled for it.  Measuring all of them in one job costs little
    beside that.  A larger dimension is returned as it is.
    """
    counts = [
        dimension.agg(F.coalesce(F.sum(row_bytes(dimension)), F.lit(0)).alias("size")).select(F.lit(i).alias("i"), "size")
        for i, dimension in enumerate(dimensions)
    ]
    sizes = {r.i: r["size"] for r in reduce(DataFrame.union, counts).collect()}
    return [F.broadcast(d) if sizes[i] <= max_bytes else d for i, d in enumerate(dimensions)]


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    default: object = None,
    only: Column | None = None,
    small: bool = False,
) -> DataFrame:
    """Left lookup that keeps every fact and adds the taken dimension columns.

    ``on`` maps fact columns to dimension columns, ``take`` maps new names to dimension columns.
    ``only`` restricts the dimension rows that may match; the facts stay whole, as with a predicate in
    the ON clause.  ``small`` states that the dimension has a fixed size bound.
    """
    side = dimension if only is None else dimension.where(only)
    side = side.select(
        *(F.col(column).alias(f"__k{i}") for i, column in enumerate(on.values())),
        *(F.col(column).alias(f"__{name}") for name, column in take.items()),
    )
    condition = F.lit(True)
    for i, column in enumerate(on):
        match = F.col(column) == F.col(f"__k{i}")
        condition = match if i == 0 else condition & match
    joined = facts.join(F.broadcast(side) if small else side, condition, "left")
    kept = [c for c in facts.columns if c not in take]
    found = {name: F.col(f"__{name}") for name in take}
    if default is not None:
        found = {name: F.coalesce(column, F.lit(default)) for name, column in found.items()}
    return joined.select(*kept, *(column.alias(name) for name, column in found.items()))


def unmatched(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not have; a NULL key never matches, so it is unmatched."""
    return source.join(target.select(*keys).distinct(), list(keys), "left_anti")


_LONG_KEY_BYTES = 64  # of one row of :func:`_long_histories`


def _spans(versions: DataFrame, key: str, start: str) -> DataFrame:
    """Bytes, number of different starts and time span of every key."""
    return versions.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__long_key")).agg(
        F.sum(row_bytes(versions)).alias("__bytes"),
        F.approx_count_distinct(start).alias("__n"),
        F.min(start).alias("__lo"),
        F.max(start).alias("__hi"),
    )


def _long_histories(spans: DataFrame, max_versions: int) -> DataFrame:
    """Keys with more than ``max_versions`` different starts, with their time span and number of slices."""
    return spans.where(F.col("__n") > max_versions).select(
        "__long_key", "__lo", "__hi", F.ceil(F.col("__n") / max_versions).cast("int").alias("__slices")
    )


def _slice_of(moment: Column) -> Column:
    """Slice number of a moment on its key's span: never decreases with time, and 0 for ordinary keys."""
    width = F.timestamp_diff("MICROSECOND", F.col("__lo"), F.col("__hi")) + F.lit(1)
    offset = F.timestamp_diff("MICROSECOND", F.col("__lo"), moment)
    # Far outside the span the quotient is large: it is held within the slices before it becomes an int.
    raw = F.floor(offset.cast("double") / width * F.col("__slices")).cast("double")
    held = F.least(F.greatest(raw, F.lit(0.0)), (F.col("__slices") - 1).cast("double"))
    return F.when(F.col("__slices").isNull(), F.lit(0)).otherwise(held.cast("int"))


def valid_at(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    version_key: str,
    at: str,
    start: str,
    end: str,
    take: Mapping[str, str],
    max_versions: int = 1000,
) -> DataFrame:
    """Left as-of lookup: the version with ``start < at <= end`` for every fact.

    Fact and version meet on the key; the interval is checked on the matching pairs.  For a key with very
    many versions that would compare every fact with the whole history, so its span is cut into slices of
    about ``max_versions`` different starts each: a version is repeated in the slices it touches, a fact
    falls into one.  Versions with one start are in one slice, however many they are.  The result is the
    same, the work per key becomes linear, and a hot key spreads over tasks.

    One job measures the versions and counts such keys first.  The keys, and the versions with or without
    slices, are broadcast when they are small, as in :func:`sized`, and joined like any other table if not.
    """
    side = versions.select(
        F.col(version_key).alias("__key"),
        F.col(start).alias("__start"),
        F.col(end).alias("__end"),
        *(F.col(column).alias(f"__{name}") for name, column in take.items()),
    )
    spans = _spans(side, "__key", "__start")
    size = spans.agg(F.sum("__bytes").alias("bytes"), F.count_if(F.col("__n") > max_versions).alias("long")).first()
    matches = (F.col(fact_key) == F.col("__key")) & (F.col(at) > F.col("__start")) & (F.col(at) <= F.col("__end"))
    left = facts
    if size.long:
        long_keys = _long_histories(spans, max_versions)
        if size.long * _LONG_KEY_BYTES <= BROADCAST_BYTES:
            long_keys = F.broadcast(long_keys)
        helper = ["__long_key", "__lo", "__hi", "__slices"]
        left = (
            facts.join(long_keys, F.col(fact_key) == F.col("__long_key"), "left")
            .withColumn("__fact_slice", _slice_of(F.col(at)))
            .drop(*helper)
        )
        touched = F.sequence(_slice_of(F.col("__start")), _slice_of(F.col("__end")))
        side = (
            side.where(F.col("__start") <= F.col("__end"))
            .join(long_keys, F.col("__key") == F.col("__long_key"), "left")
            .withColumn("__slice", F.explode(touched))
            .drop(*helper)
        )
        matches = matches & (F.col("__fact_slice") == F.col("__slice"))
        (side,) = sized(side.where(F.col("__key").isNotNull()))
    elif (size.bytes or 0) <= BROADCAST_BYTES:
        side = F.broadcast(side.where(F.col("__key").isNotNull()))
    joined = left.join(side, matches, "left")
    kept = [c for c in facts.columns if c not in take]
    return joined.select(*kept, *(F.col(f"__{name}").alias(name) for name in take))
