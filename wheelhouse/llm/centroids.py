"""Clusters of vectors around centroids; the nearest centroid is found by the threshold algorithm.

For every dimension there is a list of the centroids sorted by their value in it.  For a vector, all lists are walked
outward from the vector's own value, one entry of each list at a time.  A centroid that turns up for the first time gets
its exact distance.  A centroid that has not turned up yet is, in every dimension, at least as far off as that list's
frontier, so the walk ends as soon as the squared frontier distances add up to strictly more than the best distance.

A round assigns all vectors, adds up the components per centroid within each task and then over tasks, and moves the
centroids.  Only the centroids, whose number is a parameter, pass through the driver.

Components are integers, floor(scale * x), held within 2**25 on both sides.  Vectors that are null, of another number of
components than asked for, or hold null or non-finite components are left out.  Rows without a key come last when the
first centroids are chosen; rows with one key are ordered by their components.  Repeated rows are rows of their own.
With fewer vectors than centroids there are as many centroids as vectors; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wheelhouse.llm.batches import slices, with_batches
from wheelhouse.llm.scratch import written
from wheelhouse.llm.shipping import ship
from wheelhouse.llm.vectors import dense, finite, scaled

CENTROIDS, ROUNDS, SCALE, WIDTH = 8, 10, 1024, 64
_FAR = np.int64(1) << 28  # further than any two components


def nearest_by_threshold(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid for every row, the smaller one of equals, and the squared distance."""
    count, width = centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable")
    ranked = np.take_along_axis(centroids, order, axis=0)
    dims = np.arange(width)
    right = (ranked[None, :, :] < rows[:, None, :]).sum(axis=1)
    left = right - 1
    distances = np.full((len(rows), count), np.iinfo(np.int64).max)
    best = np.full(len(rows), np.iinfo(np.int64).max)
    open_rows = np.arange(len(rows))
    for _ in range(count):
        own, low, high = rows[open_rows], left[open_rows], right[open_rows]
        below = np.where(low >= 0, own - ranked[low, dims], _FAR)
        above = np.where(high < count, ranked[np.minimum(high, count - 1), dims] - own, _FAR)
        down = below <= above
        frontier = (np.minimum(below, above) ** 2).sum(axis=1)
        goes_on = frontier <= best[open_rows]
        open_rows, own, low, high, down = open_rows[goes_on], own[goes_on], low[goes_on], high[goes_on], down[goes_on]
        if not len(open_rows):
            break
        met = order[np.where(down, low, high), dims]
        left[open_rows] = low - down
        right[open_rows] = high + ~down
        seen = np.zeros((len(open_rows), count), bool)
        seen[np.arange(len(open_rows))[:, None], met] = True
        place, number = np.nonzero(seen & (distances[open_rows] == np.iinfo(np.int64).max))
        distances[open_rows[place], number] = ((own[place] - centroids[number]) ** 2).sum(axis=1)
        best[open_rows] = distances[open_rows].min(axis=1)
    return distances.argmin(axis=1), best


def _moved(units: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round over all rows; one without vectors stays."""
    count, width = centroids.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((count, width), np.int64), np.zeros(count, np.int64)
        for batch in batches:
            for rows in slices(batch, 1 << 20):
                own = dense(rows.column(0), width, np.int64)
                cluster, _ = nearest_by_threshold(own, centroids)
                np.add.at(sums, cluster, own)
                counts += np.bincount(cluster, minlength=count)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, width).astype(np.int32)),
                pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))),
                pa.array(sums[used].reshape(-1)),
                pa.array(np.repeat(counts[used], width)),
            ],
            names=["cluster", "position", "total", "n"],
        )

    ship(units.sparkSession)
    added = units.select("units").mapInArrow(add_up, "cluster int, position int, total bigint, n bigint")
    totals = added.groupBy("cluster", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for row in totals.collect():  # one number for each component of the centroids
        moved[row.cluster, row.position] = row.total // row.n
    return moved


def clustered(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    width: int = WIDTH,
    seed: str = "3",
) -> tuple[DataFrame, np.ndarray]:
    """(key, cluster, distance, cluster_inertia, inertia) of every vector of ``width`` components, and the centroids.

    The first centroids are the vectors whose ``seed:key`` has the smallest SHA-256.
    """
    kept = vectors.where(finite(F.col(vector)) & (F.size(vector) == width)).select(key, F.col(vector).alias("vector"))
    units = written(scaled(kept, "vector", "units", scale, width), "units")
    chance = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    first = units.orderBy(chance.asc_nulls_last(), "units").limit(count).select("units").collect()
    centroids = np.array([row["units"] for row in first], np.int64).reshape(len(first), width)
    for _ in range(rounds if len(first) else 0):
        centroids = _moved(units, centroids)

    def prepare():
        def work(column: pa.Array) -> list:
            cluster, distance = nearest_by_threshold(dense(column, width, np.int64), centroids)
            return [pa.array(cluster.astype(np.int32)), pa.array(distance)]

        return work

    found = written(with_batches(units, ["units"], "cluster int, distance bigint", prepare).drop("units"), "clusters")
    # One row for each centroid.
    sums = [(r.cluster, r.cluster_inertia) for r in found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()]
    by_cluster = found.sparkSession.createDataFrame(sums, "cluster int, cluster_inertia bigint")
    out = found.join(F.broadcast(by_cluster), "cluster").withColumn("inertia", F.lit(sum(inertia for _, inertia in sums)).cast("long"))
    return out.select(key, "cluster", "distance", "cluster_inertia", "inertia"), centroids


def digests(centroids: np.ndarray) -> list[str]:
    """SHA-256 of every centroid's components as decimal numbers."""
    return [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
