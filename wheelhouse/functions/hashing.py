"""Change-detection hashes and deterministic keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(*columns: Column) -> Column:
    """md5 over the ``|``-joined values; a NULL counts as an empty string."""
    return F.md5(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)))


def plain_hash(*columns: Column) -> Column:
    """md5 over the values without a separator; NULL as soon as one value is NULL."""
    return F.md5(F.concat(*(c.cast("string") for c in columns)))


HASHES = {"null_safe": row_hash, "concat": plain_hash}


def change_hash(policy: str, names: Sequence[str]) -> Column:
    return HASHES[policy](*(F.col(n) for n in names))


def version_key(key: Column, start: Column) -> Column:
    """Surrogate key of one version: the same natural key and start always give the same value."""
    return F.md5(F.concat_ws("|", key.cast("string"), F.date_format(start, "yyyy-MM-dd HH:mm:ss")))


def money(column: Column) -> Column:
    """Fixed-point form of an amount, so that its text does not depend on the engine."""
    return column.cast("decimal(18,2)")
