"""Slowly changing dimensions that keep every version of a row (type 2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelhouse.functions.hashing import change_hash, version_key
from wheelhouse.operators.mutate import incoming, merge


@dataclass(frozen=True)
class Type2:
    """How a dimension keeps its versions.

    ``hash_policy`` is ``"null_safe"`` or ``"concat"``; with the latter a row that holds a NULL has no
    hash and never counts as changed.
    """

    key: str
    tracked: tuple[str, ...]
    end_of_time: str = "2100-12-31 00:00:00"
    hash_policy: str = "null_safe"
    surrogate: str = "sk"
    start: str = "start_date"
    end: str = "end_date"
    current: str = "is_current"
    hash: str = "md5"

    @property
    def columns(self) -> list[str]:
        return [self.surrogate, self.key, *self.tracked, self.start, self.end, self.current, self.hash]


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def hashed(source: DataFrame, spec: Type2) -> DataFrame:
    """The key, the tracked columns and their hash."""
    return source.select(spec.key, *spec.tracked, change_hash(spec.hash_policy, spec.tracked).alias(spec.hash))


def _new_version(spec: Type2, start: Column, prefix: str = "") -> dict[str, Column]:
    key = F.col(f"{prefix}{spec.key}")
    return {
        spec.surrogate: version_key(key, start),
        spec.key: key,
        **{c: F.col(f"{prefix}{c}") for c in spec.tracked},
        spec.start: start,
        spec.end: _moment(spec.end_of_time),
        spec.current: F.lit(True),
        spec.hash: F.col(f"{prefix}{spec.hash}"),
    }


def initial_load(source: DataFrame, spec: Type2, start_ts: str) -> DataFrame:
    version = _new_version(spec, _moment(start_ts))
    return hashed(source, spec).select(*(version[c].alias(c) for c in spec.columns))


def _is_current(spec: Type2) -> Column:
    """A version whose flag is NULL is a closed one."""
    return F.coalesce(F.col(spec.current), F.lit(False))


def _once(source: DataFrame, spec: Type2) -> DataFrame:
    """The snapshot's rows, one per key; a repeated key or a NULL one is an error."""
    rows = hashed(source, spec)
    rest = [c for c in rows.columns if c != spec.key]
    single = rows.groupBy(spec.key).agg(F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*rest)).alias("__row"))
    wrong = F.when(F.col(spec.key).isNull(), "type-2 load: the snapshot has a row without key").when(
        F.col("__n") > 1, "type-2 load: the snapshot has a key twice"
    )
    sound = F.when(wrong.isNotNull(), F.raise_error(wrong).cast("boolean")).otherwise(F.lit(True))
    return single.where(sound).select(spec.key, *(F.col(f"__row.{c}").alias(c) for c in rest))


def _in_time(joined: DataFrame, spec: Type2, closes: Column, run: Column) -> DataFrame:
    """The rows, or an error if a version would end before, or when, it starts."""
    late = F.raise_error("type-2 load: the run is not after the start of a version that it closes").cast("boolean")
    return joined.where(F.when(F.coalesce(closes, F.lit(False)) & (F.col(spec.start) >= run), late).otherwise(F.lit(True)))


def _with_current(dimension: DataFrame, rows: DataFrame, spec: Type2, how: str) -> DataFrame:
    """Current versions (own names) and hashed source rows (``__s_`` names) side by side."""
    side = rows.select(*(F.col(c).alias(f"__s_{c}") for c in rows.columns), F.lit(True).alias("__s_row"))
    current = dimension.where(_is_current(spec))
    if how == "left":
        return side.join(current, F.col(spec.key) == incoming(spec.key), "left")
    return current.join(side, F.col(spec.key) == incoming(spec.key), how)


def _is_new(spec: Type2) -> Column:
    return F.col("__s_row").isNotNull() & F.col(spec.current).isNull()


def _is_changed(spec: Type2) -> Column:
    """Column by column, so that no two different rows pass for one by equal hashes.

    Under the policy ``"concat"`` a row that holds a NULL has no hash and never counts as changed.
    """
    both = F.col(spec.current).isNotNull() & F.col("__s_row").isNotNull()
    differs = F.lit(False)
    for column in spec.tracked:
        differs = differs | ~F.col(column).eqNullSafe(incoming(column))
    if spec.hash_policy == "concat":
        differs = differs & F.col(spec.hash).isNotNull() & incoming(spec.hash).isNotNull()
    return both & differs


def detect_changes(dimension: DataFrame, source: DataFrame, spec: Type2) -> DataFrame:
    """Every source row with the verdict ``new``, ``changed`` or ``unchanged``."""
    joined = _with_current(dimension, hashed(source, spec), spec, "left")
    verdict = F.when(_is_new(spec), "new").when(_is_changed(spec), "changed").otherwise("unchanged")
    return joined.select(
        *(incoming(c).alias(c) for c in (spec.key, *spec.tracked, spec.hash)), verdict.alias("change")
    )


def apply_snapshot(
    dimension: DataFrame, source: DataFrame, spec: Type2, run_ts: str, close_missing: bool = False
) -> DataFrame:
    """The dimension after a full source snapshot, from one plan.

    Current versions meet the snapshot in one full outer join; every pair gives the kept or closed
    version and, if needed, its successor.  Closed versions pass by without a shuffle.  Nothing is
    collected and nothing is committed half way.  Keys absent from the snapshot stay open unless
    ``close_missing`` is set.  A snapshot with a NULL key or a key twice is an error, as is a run that is not
    after the start of a version it closes.
    """
    run = _moment(run_ts)
    joined = _with_current(dimension, _once(source, spec), spec, "full")
    held = F.col(spec.current).isNotNull()
    closes = _is_changed(spec)
    if close_missing:
        closes = closes | (held & F.col("__s_row").isNull())
    joined = _in_time(joined, spec, closes, run)
    old = {c: F.col(c) for c in spec.columns}
    old[spec.end] = F.when(closes, run).otherwise(F.col(spec.end))
    old[spec.current] = F.when(closes, F.lit(False)).otherwise(F.col(spec.current))
    new = _new_version(spec, run, "__s_")
    versions = F.array_compact(
        F.array(
            F.when(held, F.struct(*(old[c].alias(c) for c in spec.columns))),
            F.when(_is_new(spec) | _is_changed(spec), F.struct(*(new[c].alias(c) for c in spec.columns))),
        )
    )
    closed = dimension.where(~_is_current(spec)).select(*spec.columns)
    return joined.select(F.inline(versions)).unionByName(closed)


def upsert_rows(dimension: DataFrame, source: DataFrame, spec: Type2, run_ts: str) -> DataFrame:
    """The rows to bring into the dimension: new versions and closed forms of the ones they replace."""
    run = _moment(run_ts)
    joined = _with_current(dimension, _once(source, spec), spec, "left").where(_is_new(spec) | _is_changed(spec))
    joined = _in_time(joined, spec, _is_changed(spec), run)
    new = _new_version(spec, run, "__s_")
    old = {c: F.col(c) for c in spec.columns}
    old[spec.end], old[spec.current] = run, F.lit(False)
    rows = F.array_compact(
        F.array(
            F.struct(*(new[c].alias(c) for c in spec.columns)),
            F.when(F.col(spec.key).isNotNull(), F.struct(*(old[c].alias(c) for c in spec.columns))),
        )
    )
    return joined.select(F.inline(rows))


def apply_merge(dimension: DataFrame, upserts: DataFrame, spec: Type2) -> DataFrame:
    """Merge upsert rows: closed forms close the current version of their key, the rest is inserted."""
    return merge(
        dimension.select(*spec.columns),
        upserts.select(*spec.columns),
        [spec.key],
        update={spec.end: incoming(spec.end), spec.current: incoming(spec.current)},
        insert="all",
        only_source=~_is_current(spec),
        only_target=_is_current(spec),
    )
