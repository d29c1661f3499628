"""Constraint checks as queries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent, with the number of rows that carry each; NULL is allowed.

    The child is counted per value first: the join then sees each value once, however often it occurs. Spark
    would put an anti-join that it takes for a small one below the count, and estimates keys built from stored
    columns far too low; a condition on the count keeps the join above it. The parents are sorted on disk where
    they do not fit, and never broadcast: the counts lie by key already, so only the parents' keys are moved.
    """
    used = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("key"))
    counted = used.agg(F.count(F.lit(1)).alias("row_count"))
    known = parent.select(F.col(parent_key).alias("__parent_key")).hint("merge")
    matches = (F.col("key") == F.col("__parent_key")) & (F.col("row_count") > 0)
    return counted.join(known, matches, "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once or hold a NULL."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where((F.col("row_count") > 1) | has_null)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of NULLs, all from one pass."""
    one = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns))
    return one.select(F.inline(pairs))


def outside_set(df: DataFrame, column: str, allowed: Sequence[object]) -> DataFrame:
    """Rows whose value is not one of ``allowed``; NULL passes, as in a CHECK constraint."""
    return df.where(~F.col(column).isin(list(allowed)))


def reference_check(references: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """All foreign keys of a schema at once: (name, child, its column, parent, its key) gives one row each.

    ``orphan_keys`` counts the values without a parent, ``orphan_rows`` the rows that carry them.
    """
    found = [
        orphans(child, child_key, parent.select(parent_key).distinct(), parent_key).agg(
            F.count(F.lit(1)).alias("orphan_keys"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows")
        ).select(F.lit(name).alias("reference"), "orphan_keys", "orphan_rows")
        for name, child, child_key, parent, parent_key in references
    ]
    return reduce(DataFrame.unionByName, found)
