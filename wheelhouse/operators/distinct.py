"""Exact distinct counts over data that grows, from bitmaps that are stored and merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "bucket", "bits"


def bitmaps(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One bitmap for each group and run of 32,768 values: a bit for every whole number ``value`` that occurs.

    The groups of one day are worked out once and kept; NULL values are left out, as in a distinct count.
    """
    known = df.where(F.col(value).isNotNull())
    bucket = F.bitmap_bucket_number(F.col(value).cast("bigint")).alias(BUCKET)
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(value).cast("bigint"))).alias(BITS)
    return known.groupBy(*by, bucket).agg(bits)


def merged(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups, without a look at the values: the union of the finer ones."""
    return stored.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counted(stored: DataFrame, by: Sequence[str], name: str = "distinct") -> DataFrame:
    """How many different values each group has.  Buckets hold different values, so their counts add up."""
    return merged(stored, by).groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).alias(name))
