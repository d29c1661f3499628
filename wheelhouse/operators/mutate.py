"""UPDATE, DELETE and MERGE as functions from the old table to the new one.

In expressions a plain column is the target's, ``incoming(name)`` is the source's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelhouse.functions.dates import shift_years

_MATCHES = "__s_matches"


def incoming(name: str) -> Column:
    """A source column inside an expression of :func:`merge` or :func:`update_from`."""
    return F.col(f"__s_{name}")


def _holds(condition: Column) -> Column:
    """A condition as SQL's WHERE reads it: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    hit = _holds(condition)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *(
            F.when(hit, values[c]).otherwise(F.col(c)).cast(kinds[c]).alias(c) if c in values else F.col(c)
            for c in df.columns
        )
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(~_holds(condition))


def _by_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per source key, with the number of source rows that share it."""
    rest = [c for c in source.columns if c not in keys]
    grouped = source.groupBy(*(F.col(k).alias(f"__s_{k}") for k in keys)).agg(
        F.count(F.lit(1)).alias(_MATCHES), F.any_value(F.struct(F.lit(True), *rest)).alias("__row")
    )
    return grouped.select(
        *(f"__s_{k}" for k in keys), _MATCHES, *(F.col(f"__row.{c}").alias(f"__s_{c}") for c in rest)
    )


def _same_key(keys: Sequence[str]) -> Column:
    condition = F.col(keys[0]) == incoming(keys[0])
    for key in keys[1:]:
        condition = condition & (F.col(key) == incoming(key))
    return condition


def _matched() -> Column:
    return F.col(_MATCHES).isNotNull()


def _unambiguous(df: DataFrame, in_target: Column | None = None) -> DataFrame:
    """The rows, or an error if several source rows meet one target row, as it is for MERGE.

    The error is raised by a filter, which no later choice of columns can remove.
    """
    several = F.raise_error("MERGE: several source rows match the same target row").cast("boolean")
    met = F.col(_MATCHES) > 1
    return df.where(F.when(met if in_target is None else met & in_target, several).otherwise(F.lit(True)))


def _set(target: DataFrame, condition: Column, values: Mapping[str, Column]) -> list[Column]:
    kinds = {f.name: f.dataType for f in target.schema.fields}
    return [
        F.when(condition, values[c]).otherwise(F.col(c)).cast(kinds[c]).alias(c) if c in values else F.col(c)
        for c in target.columns
    ]


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, Column] | str | None = None,
    when: Column | None = None,
    insert: Mapping[str, Column] | str | None = "all",
    only_source: Column | None = None,
    only_target: Column | None = None,
    small: bool = False,
) -> DataFrame:
    """``MERGE INTO target USING source``.

    ``update`` holds the SET list for matched rows, ``"all"`` stands for every column; ``when`` limits
    it.  ``insert`` holds the values for unmatched source rows by source column, ``"all"`` takes them as
    they are.  ``only_source`` and ``only_target`` are further terms of the ON condition on one side.

    With an update list, target and source meet once in a full outer join, which gives updates and
    inserts together: the target is read once, the source twice (its rows, and how many share a key).
    ``small`` states that the source has a fixed size bound: it is then broadcast, and the target is read
    twice but not moved.  Without an update list only the keys of the target are looked at.
    """
    if update == "all":
        update = {c: incoming(c) for c in target.columns if c in source.columns}
    can_match = source if only_source is None else source.where(_holds(only_source))
    condition = _same_key(keys) if only_target is None else _same_key(keys) & _holds(only_target)
    values = {c: F.col(c) for c in target.columns if c in source.columns} if insert == "all" else dict(insert or {})
    kinds = {f.name: f.dataType for f in target.schema.fields}

    fresh = [values.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in target.columns]

    hit = _matched() if when is None else _matched() & _holds(when)
    if small or insert is None or not update:
        changed = target
        if update:
            side = _by_key(can_match, keys)
            joined = target.join(F.broadcast(side) if small else side, condition, "left")
            changed = _unambiguous(joined).select(*_set(target, hit, update))
        if insert is None:
            return changed
        present = target if only_target is None else target.where(_holds(only_target))
        taken = present.select(*(F.col(k).alias(f"__t_{k}") for k in keys))
        if small:
            wanted = can_match.select(*(F.col(k).alias(f"__w_{k}") for k in keys)).distinct()
            taken = taken.join(F.broadcast(wanted), [F.col(f"__t_{k}") == F.col(f"__w_{k}") for k in keys], "left_semi").distinct()
        on = [F.col(k) == F.col(f"__t_{k}") for k in keys]
        new = source.join(taken, on if only_source is None else [*on, _holds(only_source)], "left_anti")
        return changed.unionByName(new.select(*fresh))

    shared = can_match.groupBy(*(F.col(k).alias(f"__n_{k}") for k in keys)).agg(F.count(F.lit(1)).alias(_MATCHES))
    counted = can_match.join(shared, [F.col(k) == F.col(f"__n_{k}") for k in keys], "left")
    side = counted.select(
        F.coalesce(F.col(_MATCHES), F.lit(1)).alias(_MATCHES),
        *(F.col(c).alias(f"__s_{c}") for c in source.columns),
        F.struct(*fresh).alias("__fresh"),
    )
    in_target = F.col("__in_target").isNotNull()
    joined = _unambiguous(target.withColumn("__in_target", F.lit(True)).join(side, condition, "full"), in_target)
    old = F.struct(*_set(target, hit, update))
    whole = joined.select(F.when(in_target, old).otherwise(F.col("__fresh")).alias("__row")).select("__row.*")
    if only_source is None:
        return whole
    return whole.unionByName(source.where(~_holds(only_source)).select(*fresh))


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """``UPDATE target SET ... FROM source``: rows without a source row stay as they are."""
    joined = target.join(_by_key(source, keys), _same_key(keys), "left")
    return _unambiguous(joined).select(*_set(target, _matched(), values))


def shift_dates(df: DataFrame, columns: Sequence[str], years: int) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: shift_years(F.col(c), years).cast(kinds[c]) for c in columns})


def expire(
    versions: DataFrame, expired: DataFrame, key: str, end: str, current: str, run_ts: str
) -> DataFrame:
    """Close the current version of every key in ``expired``."""
    marked = expired.select(F.col(key).alias("__expired")).distinct()
    hit = F.col("__expired").isNotNull() & F.col(current)
    values = {end: F.lit(run_ts).cast("timestamp_ntz"), current: F.lit(False)}
    joined = versions.join(marked, F.col(key) == F.col("__expired"), "left")
    return joined.select(*_set(versions, _holds(hit), values))
