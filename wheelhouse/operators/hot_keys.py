"""Keys that hold a large share of a table's rows, and lookups that do not gather them in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelhouse.operators.joins import lookup, sized

SHARE = 0.001
#: Keys the sketch counts at a time; every key with more than about one row in that many is among them.
TRACKED = 8192
MOST = 250_000  # hashes of one list; the sketch tracks four times as many at most


def _whole(columns: Sequence[str]) -> Column:
    """True if no part of the key is NULL."""
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))


def _hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*columns)


@dataclass(frozen=True)
class HotKeys:
    """Hashes of the frequent keys over some columns, most frequent first, with their estimated row counts.

    Only work is divided by it: a key that shares its hash with a frequent one goes the same way, so results never
    depend on the estimate.
    """

    columns: tuple[str, ...]
    counts: dict[int, int]

    def holds(self, columns: Sequence[str] | None = None) -> Column:
        """Whether a row's key is frequent; false for a NULL key."""
        columns = list(columns or self.columns)
        return _whole(columns) & _hash(columns).isin(list(self.counts)) if self.counts else F.lit(False)


def hot_keys(df: DataFrame, *keys: Sequence[str], share: float = SHARE, min_rows: int = 10_000) -> list[HotKeys]:
    """The frequent keys over each of several lists of columns, measured in one pass.

    A frequent-items sketch runs in every task and is merged, so the keys themselves are never shuffled; what comes to
    the driver is at most ``1 / share`` hashes for each list (and :data:`MOST`).  A key is frequent with ``share`` of all rows, and with
    ``min_rows`` of them, as fewer are no burden for a task.  NULL keys are left out.
    """
    most = min(max(1, round(1 / share)), MOST)

    def sketch(columns: Sequence[str]) -> Column:
        return F.call_function("approx_top_k", F.when(_whole(columns), _hash(columns)), F.lit(most), F.lit(max(TRACKED, 4 * most)))

    found = df.agg(F.count("*").alias("total"), *[sketch(columns).alias(f"k{i}") for i, columns in enumerate(keys)]).first()
    least = max(min_rows, share * found.total)
    return [
        HotKeys(tuple(columns), {item.item: item["count"] for item in found[f"k{i}"] or [] if item.item is not None and item["count"] >= least})
        for i, columns in enumerate(keys)
    ]


def lookup_hot(
    facts: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    hot: HotKeys | None = None,
    default: object = None,
    only: Column | None = None,
) -> DataFrame:
    """:func:`wheelhouse.operators.joins.lookup` into a dimension that is too large to broadcast.

    The facts go three ways.  Those with a frequent key meet the few dimension rows of these keys, which are broadcast
    when they are measured to be small; those with a NULL in their key can match nothing; neither is moved.  Only the
    rest is shuffled, and no key in it is frequent.  The facts are read once for each way, with the way's condition on
    the scan.  ``hot`` comes from :func:`hot_keys` over the columns of ``on``; without it they are measured here.
    """
    columns = list(on)
    if hot is None:
        (hot,) = hot_keys(facts, columns)
    elif list(hot.columns) != columns:
        raise ValueError(f"frequent keys of {hot.columns} do not fit a lookup on {columns}")
    options = {"on": on, "take": take, "default": default}
    side = dimension if only is None else dimension.where(only)
    side = side.select(*dict.fromkeys([*on.values(), *take.values()]))
    rest = lookup(facts.where(_whole(columns) & ~hot.holds()), side, **options)
    kept = [c for c in facts.columns if c not in take]
    kinds = {name: rest.schema[name].dataType for name in take}
    missing = [F.lit(default).cast(kinds[name]).alias(name) for name in take]
    out = rest.unionByName(facts.where(~_whole(columns)).select(*kept, *missing))
    if not hot.counts:
        return out
    (few,) = sized(side.where(hot.holds(list(on.values()))))
    return out.unionByName(lookup(facts.where(hot.holds()), few, **options))
