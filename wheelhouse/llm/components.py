"""Connected components of links between integer ids, by alternating star operations.

Each round joins every node with the smallest id among its neighbours, first from the larger neighbours' side, then
from the smaller one's; the links end as stars around the smallest id of each component after a number of rounds that
grows with the logarithm of the longest path.  A round is a few grouped minima and joins on light rows, and is written
to the shared scratch folder, so that nothing is gathered on the driver and no lineage grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wheelhouse.llm.scratch import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("hi", "lo").union(links.select(F.col("lo"), F.col("hi"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = links.join(least, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first())


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node with a link to another one; the component is its smallest id.

    Links with a null end are ignored; repeated, reversed and self links are allowed; no links give no rows.
    """
    a, b = F.col(left), F.col(right)
    known = links.where(a.isNotNull() & b.isNotNull() & (a != b))
    stars = written(known.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links")
    state = None
    while state != (state := _state(stars)):
        stars = written(_small_star(_large_star(stars)), "links")
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        stars.select(F.col("lo"), F.col("lo")).distinct()
    )
