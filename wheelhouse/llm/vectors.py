"""Vectors between Spark and numpy, and sorted rows read as runs of one key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelhouse.llm.batches import with_batches

#: Scaled components are held within this, so that every sum below fits 64 bits; embeddings are far smaller.
HELD = 1 << 25


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers; an empty one counts as such."""

    def good(x: Column) -> Column:
        number = x.cast("double")
        return x.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))

    return vector.isNotNull() & F.forall(vector, good)


def dense(column: pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    """A list column without nulls as a matrix; shorter rows go on with zeros."""
    lengths = np.asarray(column.value_lengths(), np.int64)
    flat = np.asarray(column.flatten()).astype(kind, copy=False)
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), kind)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def lists(matrix: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """The rows of a matrix as a list column."""
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(matrix.reshape(-1), kind))


def binaries(column: pa.Array, width: int) -> np.ndarray:
    """A binary column without nulls, all of one length, as a matrix of bytes."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.empty((0, width), np.uint8)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].reshape(-1, width)


def scaled(vectors: DataFrame, vector: str, name: str, factor: int, width: int) -> DataFrame:
    """``vectors`` with floor(factor * x) of all components, zeros up to ``width``, instead of ``vector``."""

    def prepare():
        def work(column: pa.Array) -> list:
            whole = np.floor(factor * dense(column, width))
            return [lists(np.clip(whole, -HELD, HELD).astype(np.int32), pa.int32())]

        return work

    return with_batches(vectors, [vector], f"{name} array<int>", prepare).drop(vector)


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by the integer columns ``keys`` as one batch for each run of equal keys; only one run is held."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([np.asarray(batch.column(batch.schema.get_field_index(key))) for key in keys])
        cuts = (np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1).tolist()
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            key = tuple(values[:, low].tolist())
            if held and key != last:
                yield _joined(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = key
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
