"""Codes for vectors: each part of a vector is named by the nearest entry of that part's codebook.

The nearest entry is found by the equal-average search.  Entries are sorted by the sum of their components.  For two
vectors of d components, the squared gap between their sums is at most d times their squared distance.  So the search
begins at the entries whose sums are closest to the part's sum, goes outward on both sides, and ends as soon as the
squared gap over d is strictly more than the best distance: no entry further out can be as near, or as near with a
smaller index.

Codebooks are learned in rounds: every round assigns all parts, adds up the components per entry within each task and
then over tasks, and moves the entries.  A codebook is as large as ``entries`` vectors, whatever the table holds; it is
all that passes through the driver.

Components are integers, floor(scale * x), held within 2**25 on both sides.  Vectors that are null or hold null or
non-finite components are left out.  Shorter vectors go on with zeros up to the longest one, and all of them up to a
multiple of the number of parts.  Rows without a key come last among the starting entries; rows with one key are ordered
by their components.  Repeated rows are rows of their own.  With fewer rows than entries, the codebooks are as short as
that; an empty table has no rows and empty codebooks.
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
from wheelhouse.operators.joins import sized

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


def nearest_by_sum(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of ``book`` for every row, the smaller one of equals, and the squared distance."""
    size, width = len(parts), parts.shape[1]
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    ranked = sums[order]
    own = parts.sum(axis=1)
    right = np.searchsorted(ranked, own)
    left = right - 1
    best = np.full(size, np.iinfo(np.int64).max)
    index = np.full(size, len(book))
    far = np.iinfo(np.int64).max
    rows = np.arange(size)
    while len(rows):
        below = np.where(left[rows] >= 0, own[rows] - ranked[left[rows]], far)
        above = np.where(right[rows] < len(book), ranked[np.minimum(right[rows], len(book) - 1)] - own[rows], far)
        gap = np.minimum(below, above)
        # A hair beyond the bound, as large squares are rounded: that only looks at an entry more.
        within = (gap < far) & (gap.astype(float) ** 2 <= best[rows].astype(float) * width * (1 + 1e-9))
        rows, down = rows[within], (below <= above)[within]
        entry = order[np.where(down, left[rows], right[rows])]
        left[rows[down]] -= 1
        right[rows[~down]] += 1
        distance = ((parts[rows] - book[entry]) ** 2).sum(axis=1)
        better = (distance < best[rows]) | ((distance == best[rows]) & (entry < index[rows]))
        best[rows[better]], index[rows[better]] = distance[better], entry[better]
    return index, best


def assigned(units: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry of every part (rows x parts), and the squared distance over all parts; ``books`` is parts x entries x width."""
    width = books.shape[2]
    found = [nearest_by_sum(units[:, p * width : (p + 1) * width], book) for p, book in enumerate(books)]
    return np.stack([index for index, _ in found], axis=1), np.sum([distance for _, distance in found], axis=0)


def _moved(units: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all rows."""
    parts, entries, width = books.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for rows in slices(batch):
                own = dense(rows.column(0), parts * width, np.int64)
                index, _ = assigned(own, books)
                for p in range(parts):
                    np.add.at(sums[p], index[:, p], own[:, p * width : (p + 1) * width])
                    counts[p] += np.bincount(index[:, p], minlength=entries)
        used = np.argwhere(counts > 0)
        place = np.repeat(used, width, axis=0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(place[:, 0].astype(np.int32)),
                pa.array(place[:, 1].astype(np.int32)),
                pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))),
                pa.array(sums[tuple(used.T)].reshape(-1)),
                pa.array(counts[tuple(place.T)]),
            ],
            names=["part", "entry", "position", "total", "n"],
        )

    ship(units.sparkSession)
    added = units.select("units").mapInArrow(add_up, "part int, entry int, position int, total bigint, n bigint")
    totals = added.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    moved = books.copy()
    for row in totals.collect():  # one number for each component of the codebooks
        moved[row.part, row.entry, row.position] = row.total // row.n
    return moved


def learned(units: DataFrame, key: str, width: int, parts: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks (parts x entries x width of a part) for rows with the columns ``key`` and ``units``."""
    first = units.select(key, "units").orderBy(F.col(key).asc_nulls_last(), "units").limit(entries).collect()
    start = np.array([row["units"] for row in first], np.int64).reshape(len(first), parts, width // parts)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    for _ in range(rounds if len(first) else 0):
        books = _moved(units, books)
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal numbers, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compressed(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(key, label, code, error, label_error) of every vector, and the codebooks."""
    own = vectors.where(finite(F.col(vector))).select(key, F.col(label).alias("group"), F.col(vector).alias("vector"))
    longest = own.agg(F.max(F.size("vector"))).first()[0] or 1
    width = -(-longest // parts) * parts
    units = written(scaled(own, "vector", "units", scale, width), "units")
    books = learned(units, key, width, parts, entries, rounds)

    def prepare():
        def work(column: pa.Array) -> list:
            index, error = assigned(dense(column, width, np.int64), books)
            return [[bytes(row).hex() for row in index.astype(np.uint8)], pa.array(error)]

        return work

    coded = written(with_batches(units, ["units"], "code string, error bigint", prepare).drop("units"), "codes")
    (by_label,) = sized(coded.groupBy("group").agg(F.sum("error").alias("label_error")).withColumnRenamed("group", "same"))
    out = coded.join(by_label, F.col("group").eqNullSafe(F.col("same")))
    return out.select(key, F.col("group").alias(label), "code", "error", "label_error"), books
